"""Structured Streaming forms of routing, yield windows, dedup and the gate."""
