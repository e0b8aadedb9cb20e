"""Structured Streaming forms of the event log, breaker, reuse and counters."""
