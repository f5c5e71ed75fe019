"""Training-data operators over ``documents``-like tables.

Nothing else in the library imports this sub-package; it may be removed whole.
"""
