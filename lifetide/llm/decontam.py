"""Benchmark decontamination by template windows (operator 8, native).

Texts become templates: numbers, units after numbers and names (capitalised
words inside a sentence) turn into typed placeholders, all else into lower-case
words.  Every window of ``WINDOW`` template tokens of an item is hashed and
joined with the windows of every document.  A question whose numbers or names
were changed still matches, so the values are checked next: in one occurrence
(one offset between document and item) each value of the item must stand for
one value of the document throughout; occurrences that mix values are dropped.
A document is contaminated by an item when the occurrences that stay cover at
least ``MIN_COVERAGE`` of the item's tokens.

The document side streams past the windows of the benchmark when those are at
most ``STREAMED`` (counted first); else both sides shuffle by window hash.  Only
matching windows go on, so everything after the join is small.  Slot values are
read from the documents that have hits, whose ids are broadcast if they are at most
``FOUND_STREAMED``; if more, the windows of all documents stream past the benchmark's again, now
with their placeholders.  Either way no text is shuffled.

Items of fewer than ``WINDOW`` template tokens have no such window.  They are
found as they are written: the words, numbers and signs of the entire item must
stand in a row in the document (case, blanks and other punctuation aside; a
script without blanks counts by character).  Windows of up to ``WINDOW`` of
these are joined by hash, and all of an item's must be found at one offset.

Defined results: null and empty texts, texts of fewer than ``WINDOW`` tokens
(but for shorter items), and items without a template token match nothing; rows with the same doc_id (or item_id) count
as one document (item) if equal, and their windows are pooled if not; repeated
rows add nothing; rows without an id cannot be reported (``clean`` keeps them);
empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifetide.llm.common import columns_but, stage, text_or_empty

WINDOW = 8
MIN_COVERAGE = 0.5
STREAMED = 200_000         # windows of the benchmark that are broadcast (about 5 MB); more are shuffled
FOUND_STREAMED = 500_000   # ids of documents with hits that are broadcast (about 10 MB) to read their placeholders

# Units that may follow a number.
UNITS = ("kg", "mg", "g", "km", "cm", "mm", "m", "ml", "l", "kmh", "mph", "miles", "mile", "feet", "inches", "pounds", "ounces",
         "seconds", "minutes", "hours", "days", "weeks", "months", "years", "dollars", "euros", "cents", "percent", "degrees")
_UNIT_WORDS = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))

# (pattern, replacement with the value, replacement without); a mark is a rare letter, the type and the value in brackets
STEPS = (
    (rf"(\d) ?((?i:{_UNIT_WORDS}))\b", "$1 ǂunit⟦$2⟧ ", "$1 ǂunit "),
    (r"([$€£%°])", " ǂunit⟦$1⟧ ", " ǂunit "),
    (r"([\p{L}\p{N},;:] )(\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*+)", "$1ǂname⟦$2⟧ ", "$1ǂname "),
    (r"(\d+(?:[.,]\d+)*+)", " ǂnum⟦$1⟧ ", " ǂnum "),
)
# (the groups are possessive: nothing follows them, and Java's matcher recurses once per repetition of any other)
TOKEN_MARKED = r"ǂ[a-z]+⟦[^⟧]*⟧|ǂ?\p{L}+"
# Words, numbers and signs as they are written (for short items).
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
PLAIN = rf"[{_UNSPACED}]|[\p{{L}}\p{{M}}&&[^{_UNSPACED}]]+|\d+(?:[.,]\d+)*+|\p{{N}}|[$€£%°+*/=<>^×÷−-]"


def template(text: Column, with_values: bool = False) -> Column:
    """Lower-case template text; ``with_values`` keeps the replaced values in brackets."""
    out = text
    for pattern, marked, bare in STEPS:
        out = F.regexp_replace(out, pattern, marked if with_values else bare)
    return F.lower(out)


def tokens(text: Column) -> Column:
    """Template tokens (the rare mark is itself a letter)."""
    return F.filter(F.split(template(text), r"[^\p{L}]+"), lambda t: t != "")


def marked_tokens(text: Column) -> Column:
    """The same tokens, placeholders with the value that they replace."""
    return F.regexp_extract_all(template(text, True), F.lit(TOKEN_MARKED), F.lit(0))


def _type_of(token: Column) -> Column:
    return F.substring_index(token, "⟦", 1)


def _hashed(words: Column) -> Column:
    """A hash per word: windows are hashed from these, no word is read again for each window that holds it."""
    return F.transform(words, lambda w: F.xxhash64(w))


def _at(column: str, start: Column, window: int) -> list[Column]:
    """The ``window`` entries from ``start`` (from 0), each read by its place (a slice would copy the whole array for each window)."""
    return [F.get(F.col(column), start + k) for k in range(window)]


def _starts(hashes: str, window: int) -> Column:
    return F.sequence(F.lit(0), F.size(hashes) - window)


def _windows(df: DataFrame, id_col: str, window: int) -> DataFrame:
    """One row per window: place, hash."""
    toks = df.select(F.col(id_col), _hashed(tokens(text_or_empty())).alias("_t"))
    hashes = F.when(F.size("_t") >= window, F.transform(_starts("_t", window), lambda i: F.xxhash64(*_at("_t", i, window))))
    return toks.select(id_col, F.posexplode(hashes).alias("_p", "_h"))


def _marked_windows(df: DataFrame, id_col: str, window: int) -> DataFrame:
    """The same, with the number of tokens and the placeholders ``_k`` of the window (null where a word stands)."""
    placeholder = F.transform("_m", lambda m: F.when(F.contains(m, F.lit("⟦")), m))
    toks = (df.select(F.col(id_col), marked_tokens(text_or_empty()).alias("_m"))
            .withColumns({"_n": F.size("_m"), "_t": _hashed(F.transform("_m", _type_of)),
                          "_k": F.when(F.exists("_m", lambda m: F.contains(m, F.lit("⟦"))), placeholder)}).drop("_m"))
    each = F.when(F.col("_n") >= window, F.transform(_starts("_t", window), lambda i: F.struct(
        F.xxhash64(*_at("_t", i, window)).alias("h"), F.when(F.col("_k").isNotNull(), F.array(*_at("_k", i, window))).alias("k"))))
    return (toks.select(id_col, "_n", F.posexplode(each).alias("_p", "_w"))
            .select(id_col, "_n", "_p", F.col("_w.h").alias("_h"), F.col("_w.k").alias("_k")))


def _marks() -> Column:
    """Placeholders of a window: place in the text, and the marked token."""
    return F.filter(F.transform("_k", lambda m, i: F.struct((F.col("_p") + i).alias("pos"), m.alias("token"))),
                    lambda s: F.coalesce(F.contains(s["token"], F.lit("⟦")), F.lit(False)))


def _values(rows: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """One row per placeholder of the windows in ``rows`` (with ``marks``): position, type, value."""
    # an outer explode: for an inner one Spark infers a filter on the marks and moves it below the join with the ids
    # found, so that the marks of every document would be read
    return (rows.select(F.col(id_col), F.explode_outer("marks").alias("_k")).filter(F.col("_k").isNotNull()).distinct()
            .select(id_col, F.col("_k.pos").alias(f"{prefix}pos"), _type_of(F.col("_k.token")).alias(f"{prefix}type"),
                    F.col("_k.token").alias(f"{prefix}value")))


def _marks_found(docs: DataFrame, hits: DataFrame, theirs: DataFrame, window: int) -> DataFrame:
    """doc_id, marks: the placeholders of the documents (or the windows) that have hits; texts are read again but not shuffled."""
    found = stage(hits.select("doc_id").distinct(), "decontam-found")
    if found.count() <= FOUND_STREAMED:
        tokens_of = docs.join(F.broadcast(found), "doc_id", "left_semi").select("doc_id", marked_tokens(text_or_empty()).alias("_k"), F.lit(0).alias("_p"))
        return tokens_of.select("doc_id", _marks().alias("marks"))
    return _marked_windows(docs, "doc_id", window).select("doc_id", "_h", _marks().alias("marks")).join(theirs, "_h", "inner").select("doc_id", "marks")


def plain(text: Column) -> Column:
    """Words, numbers and signs of a text, lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(PLAIN), F.lit(0))


def _plain_windows(df: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """One row per window of ``sizes`` words of ``_w`` (their hashes): position and hash."""
    def of(n: int) -> Column:
        return F.when(F.size("_w") >= n, F.transform(_starts("_w", n), lambda i: F.struct(i.alias("p"), F.xxhash64(*_at("_w", i, n)).alias("h"))))
    found = F.flatten(F.filter(F.array(*map(of, sizes)), lambda a: a.isNotNull()))
    return df.select(*keep, F.explode(found).alias("_x")).select(*keep, "_x.p", "_x.h")


def _short_items(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame | None:
    """doc_id, item_id, item_tokens of every item of fewer than ``window`` template tokens that a document holds as it is written."""
    short = (benchmark.select("item_id", F.size(tokens(text_or_empty())).alias("item_tokens"), plain(text_or_empty()).alias("_w"))
             .filter((F.col("item_tokens") > 0) & (F.col("item_tokens") < window) & (F.size("_w") > 0)).distinct()
             .withColumn("_size", F.least(F.size("_w"), F.lit(window))))
    sizes = sorted(r[0] for r in short.select("_size").distinct().collect())      # at most ``window`` numbers
    if not sizes:
        return None
    short = short.withColumns({"_item": F.xxhash64("_w"), "_all": F.size("_w") - F.col("_size") + 1, "_w": _hashed(F.col("_w"))})
    keys = ("item_id", "_item", "item_tokens", "_all")
    theirs = [_plain_windows(short.filter(F.col("_size") == n), [n], *keys) for n in sizes]
    theirs = functools.reduce(DataFrame.union, theirs).withColumnRenamed("p", "_ip")
    ours = _plain_windows(docs.select("doc_id", _hashed(plain(text_or_empty())).alias("_w")), sizes, "doc_id")
    return (ours.join(theirs, "h", "inner").groupBy("doc_id", *keys, (F.col("p") - F.col("_ip")).alias("_shift"))
            .agg(F.count_distinct("_ip").alias("_hits")).filter("_hits = _all")
            .groupBy("doc_id", "item_id").agg(F.max("item_tokens").cast("long").alias("item_tokens")))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, covered, item_tokens, coverage, exact."""
    docs = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text")
    benchmark = benchmark.filter(F.col("item_id").isNotNull()).select("item_id", "text")
    items = stage(_marked_windows(benchmark, "item_id", window).select("item_id", "_n", "_p", "_h", _marks().alias("marks")), "decontam-items")
    theirs = items.groupBy("item_id", F.col("_p").alias("_ip"), "_h").agg(F.max("_n").alias("item_tokens"))
    theirs = F.broadcast(theirs) if items.count() <= STREAMED else theirs
    hits = stage(_windows(docs, "doc_id", window).select("doc_id", F.col("_p").alias("_dp"), "_h").join(theirs, "_h", "inner").drop("_h").distinct(),
                 "decontam-hits")
    # covered positions of each occurrence (document position = item position + shift)
    covered = (hits.select("doc_id", "item_id", "item_tokens", (F.col("_dp") - F.col("_ip")).alias("_shift"),
                           F.explode(F.sequence(F.col("_ip"), F.col("_ip") + (window - 1))).alias("_pos")).distinct())
    item_values = _values(items, "item_id", "_i")
    doc_values = _values(_marks_found(docs, hits, theirs, window), "doc_id", "_d")
    slots = (covered.join(item_values, (covered["item_id"] == item_values["item_id"]) & (F.col("_pos") == F.col("_ipos")), "inner")
             .select("doc_id", covered["item_id"], "_shift", "_pos", "_itype", "_ivalue"))
    slots = (slots.join(doc_values.withColumnRenamed("doc_id", "_doc"),
                        (F.col("doc_id") == F.col("_doc")) & (F.col("_pos") + F.col("_shift") == F.col("_dpos"))
                        & (F.col("_itype") == F.col("_dtype")), "inner")
             .groupBy("doc_id", "item_id", "_shift", "_itype", "_ivalue")
             .agg(F.min("_dvalue").alias("_lo"), F.max("_dvalue").alias("_hi")))
    verdict = (slots.groupBy("doc_id", "item_id", "_shift")
               .agg(F.bool_and(F.col("_lo") == F.col("_hi")).alias("_consistent"),
                    F.bool_and((F.col("_lo") == F.col("_ivalue")) & (F.col("_hi") == F.col("_ivalue"))).alias("_same")))
    kept = (covered.join(verdict, ["doc_id", "item_id", "_shift"], "left")
            .filter(F.coalesce("_consistent", F.lit(True))))
    full = (kept.groupBy("doc_id", "item_id", "_pos")
            .agg(F.max("item_tokens").alias("item_tokens"), F.bool_or(F.coalesce("_same", F.lit(True))).alias("_same"))
            .groupBy("doc_id", "item_id")
            .agg(F.count(F.lit(1)).alias("covered"), F.max("item_tokens").cast("long").alias("item_tokens"), F.bool_and("_same").alias("exact"))
            .withColumn("coverage", F.col("covered") / F.col("item_tokens"))
            .filter(F.col("coverage") >= min_coverage)
            .select("doc_id", "item_id", "covered", "item_tokens", "coverage", "exact"))
    short = _short_items(docs, benchmark, window)
    if short is None:
        return full
    whole = short.select("doc_id", "item_id", F.col("item_tokens").alias("covered"), "item_tokens", F.lit(1.0).alias("coverage"), F.lit(True).alias("exact"))
    # an item id may stand for a short and a long text: the better match is reported
    best = F.max(F.struct("coverage", "covered", "item_tokens", "exact")).alias("_best")
    return (full.union(whole).groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "_best.covered", "_best.item_tokens", "_best.coverage", "_best.exact"))


def clean(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """``docs`` without the documents that some item contaminates; all columns."""
    bad = stage(contaminated(docs, benchmark, **params).select("doc_id").distinct(), "decontam-ids")
    return docs.join(bad, "doc_id", "left_anti").select(*columns_but(docs))
