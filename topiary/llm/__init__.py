"""Operators for preparing large text collections as training data.

Nothing else in the library imports this package. Each module holds one
operator with its general interface; ``queries.py`` derives the registered
``opN_*`` results from them.
"""
