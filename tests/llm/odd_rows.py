"""Rows that every operator must take: nulls, repeats, ties, long texts, clashing column names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k string, _row string, spans int, label string"
REPEATED = "some words here, repeated and long enough"
ODD = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, REPEATED), (None, None), (4, "long " * 20_000), (5, REPEATED)]


def docs_of(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", "r", 1, "l") for i, t in rows], SCHEMA)
