"""Structured Streaming: continuous bar upserts."""
