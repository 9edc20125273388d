"""Operators for text corpora: language, archives, packing, personal data, pages, contamination, near copies, models, search."""
