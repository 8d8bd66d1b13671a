"""Operators for preparing training data: one module per operator, DataFrame in, DataFrame out."""
