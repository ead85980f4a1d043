"""Operators for preparing training text: each module is one operator over a documents table."""
