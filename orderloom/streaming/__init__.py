"""Event-driven variants of the raw load and the retry dedup."""
