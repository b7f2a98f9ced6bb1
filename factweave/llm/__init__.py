"""Training-data operators: extraction, deduplication, search, scanning, quality, packing and mixing.

Nothing outside this folder imports it, so the folder can be removed without touching the rest of the library.
"""
