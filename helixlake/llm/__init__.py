"""Training-data operators: scoring, near-duplicate search, mixing, tokenisation.

Nothing outside this folder imports it.
"""
