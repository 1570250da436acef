"""Operators for preparing training data: text, URL, chat and licence records."""
