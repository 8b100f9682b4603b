"""Training-data operators: each module holds one operator, ``queries`` its registered queries.

Nothing else in the library imports this package.
"""
