"""Training-data operators: scoring, deduplication, tokenizing, packing, sharding, search.

Every module takes and returns DataFrames and stands on its own; nothing
outside this subpackage imports it.
"""
