"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; ``queries`` and ``sql`` hold what ``__spark_entry__`` registers.
"""
