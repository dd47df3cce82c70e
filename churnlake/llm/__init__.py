"""Training-data operators: scoring, deduplication, search, classification,
tokenization and secret scans over large text tables.

Nothing else in the package imports this subpackage."""
