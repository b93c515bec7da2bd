"""Structured Streaming: watermarks, keyed state, jobs."""
