"""Structured Streaming jobs and the message decoding they share with batch."""
