"""Quire: a PySpark engine that prepares and analyses large text corpora."""
