"""Operators for preparing training text, each by a method of its own; nothing else in the package imports them."""
