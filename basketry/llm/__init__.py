"""Training-data operators: language ID, license scans, near-duplicate search,
mixing, chat formatting, language-model scoring, substring dedup, quality
classification, benchmark decontamination, line dedup, a Merkle manifest and
phrase collocations.

Nothing else in the library imports this subpackage.  ``registry.py`` lists
the named queries and their DuckDB SQL.
"""
