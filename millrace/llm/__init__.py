"""Operators for preparing web-scale training text; nothing outside imports them."""
