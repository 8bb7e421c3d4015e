"""Rows with nulls, empty and long texts, ties and repeats that every operator must take."""

from __future__ import annotations

LONG = "lorem ipsum dolor sit amet " * 4000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "x"),
    (2, "THE QUICK brown fox jumps over the lazy dog", None),
    (3, None, "x"),
    (4, "", "x"),
    (None, "no id here at all", "x"),
    (None, "no id here at all", "x"),
    (5, LONG, "x"),
    (6, "aé中\U0001f600 \t\r\n\x1c  b", "x"),
    (7, "repeated row of text", "x"),
    (7, "repeated row of text", "x"),
    (8, "x" * 5000, "x"),
    (9, "   \n ", "x"),
]


def documents(spark, rows=ROWS):
    """With extra columns, some of which have names that operators use themselves."""
    return spark.createDataFrame([(*r, r[0], "n", 1.5) for r in rows],
                                 "doc_id bigint, text string, lang string, row_no bigint, segment string, score double")


def pages(spark, rows):
    return spark.createDataFrame([(*r, "n", 7) for r in rows], "page_id bigint, url string, html string, host string, run int")
