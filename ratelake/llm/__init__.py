"""Operators for large text corpora (one module per operator).

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
only when the folder is present.
"""
