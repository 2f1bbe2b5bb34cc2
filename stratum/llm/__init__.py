"""Operators for large-scale training-data work: token counts, packing, deduplication, search, chat formatting."""
