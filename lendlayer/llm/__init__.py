"""Training-data operators: scoring, filtering, de-duplication, mixing, formatting, packing.

Nothing else in the library imports this subpackage. Each ``opN_*`` module holds one
operator with its own general interface; ``queries`` registers one thin query for each.
"""
