"""Training-data operators: deduplication, decontamination, quality, extraction, tokens, shards.

Each module holds one operator with its own general interface; ``queries`` holds the thin
``opN_<name>`` queries over the driver tables. Nothing else in the library imports this package.
"""
