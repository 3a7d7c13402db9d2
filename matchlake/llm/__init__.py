"""Operators that prepare a text corpus for training. Nothing else in the library imports them."""
