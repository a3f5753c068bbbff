"""Pricing operators: DataFrame in, DataFrame out."""
