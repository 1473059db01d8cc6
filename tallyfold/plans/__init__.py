"""Operators put together: the write path, and queries over the event tables."""
