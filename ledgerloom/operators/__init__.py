"""Relational building blocks: DataFrame in, DataFrame out."""
