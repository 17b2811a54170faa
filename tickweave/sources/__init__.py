"""Readers and parsers for tick lines, feed logs, edge logs and request logs."""
