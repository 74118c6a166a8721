"""Operators of a training-data pipeline over web-scale text: one module per operator."""
