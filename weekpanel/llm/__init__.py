"""Operators for preparing large text corpora on Spark.

Nothing else in the package imports this folder. Each module holds one
operator with a general interface; ``queries`` registers the thin ``opN_``
queries and their SQL."""
