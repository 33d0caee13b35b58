"""Streaming sinks and runners."""
