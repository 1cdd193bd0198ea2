"""Training-data operators: quality, privacy, language, tokens, duplicates, licences, shards and mixtures.

Nothing else in the library imports this subpackage.
"""
