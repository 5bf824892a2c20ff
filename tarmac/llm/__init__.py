"""Operators for preparing training text at scale; see the README for one line on each."""
