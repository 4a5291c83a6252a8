"""Operators that prepare text for training; nothing else in the library imports them."""
