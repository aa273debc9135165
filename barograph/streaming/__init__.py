"""Streaming sinks and the care of running queries."""
