"""Structured Streaming forms of the daily close (T-1) and live scoring (T-2)."""
