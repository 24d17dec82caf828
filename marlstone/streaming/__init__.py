"""Structured Streaming: live aggregates, stateful detectors, incremental reports."""
