"""Operators for preparing training data: packing, deduplication, search, scoring and scanning at corpus scale."""
