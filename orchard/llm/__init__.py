"""Training-data operators: deduplication, decontamination, scans, packing, sharding, language ID.

Each module holds one operator with a general interface; ``queries`` derives the digest
tables of the registered ``opN_*`` queries from them. Nothing else in the library imports
this subpackage.
"""
