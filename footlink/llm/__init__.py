"""Operators for preparing training text at scale (independent of the rest
of the library: nothing outside this subpackage imports it)."""
