"""Training-data operators: packing, deduplication, scans, quality rules,
decontamination, language identification and archive fixity.

Nothing else in the library imports this subpackage.
"""
