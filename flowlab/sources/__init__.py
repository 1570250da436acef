"""Tables, models and reports on shared storage."""
