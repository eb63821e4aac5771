"""Training-data operators: one module each, their named queries in ``queries``.

Nothing else in the library imports this subpackage.
"""
