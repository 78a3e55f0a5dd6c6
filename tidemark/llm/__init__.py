"""Operators for preparing training corpora: scans, counts, filters, deduplication, packing."""
