"""Operators for preparing text corpora to train language models.

Nothing else in the library imports this package. Each module holds one
operator; ``queries`` registers them over the benchmark tables.
"""
