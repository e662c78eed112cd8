"""Operators for preparing training text: one module each, over any DataFrame with
the named columns.  Nothing else in the library imports this package."""
