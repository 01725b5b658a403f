"""Structured Streaming tiers of an event stream."""
