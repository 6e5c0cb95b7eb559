"""Operators for building language-model training corpora on Spark.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when the package is present.
"""
