"""Small frames that every operator must bear."""

from __future__ import annotations

LONG = "one very long text of many words " * 6000

EDGE_ROWS = [
    (1, None, "en", "s"),
    (2, "", "en", "s"),
    (3, " \n\t \n", None, "s"),
    (4, "A", "en", None),
    (5, LONG, "en", "s"),
    (6, "Zwölf Boxkämpfer jagen Viktor\nquer über den großen Sylter Deich", "de", "t"),
    (7, "Zwölf Boxkämpfer jagen Viktor\nquer über den großen Sylter Deich", "de", "t"),
    (7, "Zwölf Boxkämpfer jagen Viktor\nquer über den großen Sylter Deich", "de", "t"),
    (8, "the quick brown fox jumps over the lazy dog and runs away from the other dogs", "en", "t"),
    (9, "!!! ??? 123 $$$ <|endoftext|> ***", "xx", "t"),
    (None, "a text without an id that is still a text", "en", "t"),
    (10, "x" * 5000 + " 日本語 テキスト  　 end ", "ja", "t"),
]
#: Columns whose names the operators use inside, or return.
CLASHES = {c: f"CAST(7 AS BIGINT) AS {c}" for c in ("k", "n", "h", "item", "items", "shard", "slot", "length", "piece", "score", "toxicity", "language", "contamination", "held_out", "n_words", "host", "size", "rows")}


def edge(spark):
    rows = spark.createDataFrame(EDGE_ROWS, "doc_id long, text string, lang string, source string")
    return rows.selectExpr("*", *CLASHES.values())


def empty(spark):
    return edge(spark).where("false")


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.select(column).collect()), key=lambda x: (x is None, x))


ALL_IDS = sorted((r[0] for r in EDGE_ROWS), key=lambda x: (x is None, x))
