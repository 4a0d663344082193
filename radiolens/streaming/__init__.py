"""Structured Streaming: incremental pair sums per event-time window."""
