"""Rows that every operator over documents must take."""
from __future__ import annotations


def odd_documents(spark, documents=None):
    """Nulls in every column, empty and long texts, repeated rows, a clashing extra column."""
    rows = [(None, None, None, None, None), (-1, "", "en", "s", 0), (-2, None, "en", "s", None),
            (-3, "one two", "en", "s", 7), (-3, "one two", "en", "s", 7), (-4, " \t\n ", "de", None, 4),
            (-5, "Ünïcödé 日本語 🎉 " * 40, "xx", "t", 1), (-6, "word " * 30_000, "en", "t", 150_000),
            (-7, "x" * 60_000, "en", "t", 60_000), (None, "one two three four five six", "en", "t", 5)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return odd if documents is None else documents.unionByName(odd)
