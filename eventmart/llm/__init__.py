"""Operators of a training-data pipeline: text quality, mixing, deduplication, search, packing.

Each module holds one operator. Its general functions come first; the last function is the
registered query, which applies the operator to a whole table with production parameters.
``queries`` collects them. Nothing else in the library imports this subpackage.
"""
