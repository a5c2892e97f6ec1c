"""Training-data operators: extraction, formatting, tokens, duplicates, mixing, search.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` registers one thin query per
operator and the corpus pipeline.
"""
