"""Training-data operators: search, token counts, chat formatting, BPE, archives,
toxicity, near-duplicates, source mixing, vector near-duplicates and quality.

Nothing else in the library imports this subpackage.
"""
