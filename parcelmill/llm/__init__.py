"""Operators for preparing text corpora. Nothing else in the package imports this subpackage."""
