"""Training-data operators: quality, language, decontamination, near copies, archives, shards and tokens.

Nothing else in the library imports this subpackage.
"""
