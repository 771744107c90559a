"""Operators on text corpora: sharding, packing, scans, filters, duplicates, language."""
