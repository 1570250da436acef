"""Scoring of arriving rows with Structured Streaming."""
