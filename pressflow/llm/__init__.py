"""Operators that prepare documents and conversations for training language models.

Nothing else in the package imports this subpackage; ``catalogue`` holds its queries.
"""
