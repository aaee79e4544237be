"""Structured Streaming: sources and watermarked window statistics, stateful
rolling detectors (state store or per-micro-batch state tables), stateless
model scoring, counters, alerts and the per-record message path."""
