"""Operators on records: DataFrame in, DataFrame out."""
