"""Rows shared by the tests of this folder."""

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("_id", "_h", "_old", "_made", "_new", "_found", "_owner", "_cut", "score", "predicted", "n", "tile", "component_id", "size", "target",
           "n_found", "n_removed", "item_id", "a")

LONG = " ".join(f"word{i % 977}x{i % 31} tail." if i % 9 == 0 else f"w{i % 1013}" for i in range(30_000))
#: id, text: null and empty texts, blanks, one word, a very long text, repeated rows, equal texts, null ids
ODD = [(1, None), (2, ""), (3, " \t\n "), (4, "word"), (5, LONG), (6, "Some plain text. With two sentences."), (6, "Some plain text. With two sentences."),
       (7, "Some plain text. With two sentences."), (8, "ünïcödé ß — ¡ñ! 𝔘𝔫𝔦 x"), (None, "no id here"), (None, None)]


def frame(spark, rows, extra=False):
    """documents rows from (doc_id, text[, lang, source]); ``extra``: columns named like what operators use and return."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    return df.withColumns({c: F.lit("x") for c in CLASHES}) if extra else df
