"""Operators that prepare text, vectors and conversations for training language models.

Nothing else in the library imports this subpackage; it can be removed as a whole.
"""
