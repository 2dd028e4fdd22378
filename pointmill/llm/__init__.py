"""Operators for preparing training data: text, vectors, archives and token ids."""
