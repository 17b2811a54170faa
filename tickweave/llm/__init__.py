"""Operators for preparing training text at scale, each with its query and test."""
