"""Unattended updates with Structured Streaming."""
