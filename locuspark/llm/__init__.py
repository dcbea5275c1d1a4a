"""Training-data operators: language, quality, duplicates, secrets, licences, mixing, packing, tokens, search.

Nothing else in the package imports this subpackage. Each module holds one
operator with a general interface; ``queries`` binds them to the given tables.
"""
