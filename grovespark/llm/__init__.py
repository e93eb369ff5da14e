"""Operators for preparing training corpora: one module per operator, queries in ``entries``."""
