"""Format-preserving pseudonyms for personal data (operator 5, native).

Numbers and dates that pass their validity check are replaced by a keyed
permutation of their own format: a Feistel network by addition on Z_m x Z_n,
which is a bijection for any m and n, so equal values keep equal pseudonyms in
every document, different ones stay different, and a valid number becomes a
valid number of the same shape.

  card   13-19 digits (plain, or 4-4-4-4 with blanks or hyphens) that pass the
         Luhn check: all but the last digit are permuted, the check digit is set anew
  phone  ``(ddd) ddd-dddd`` with or without ``+c ``, and ``ddd-ddd-dddd``: its ten digits
  ssn    ``ddd-dd-dddd`` with area 001-899 but 666, group 01-99, serial 0001-9999
  ip     four octets of at most 255: as two 16-bit halves
  date   a calendar day ``yyyy-mm-dd`` or ``dd/mm/yyyy`` of the years 1000-9799:
         its day number within its 400-year Gregorian cycle (146,097 = 189 x 773 days)
E-mail addresses and long hexadecimal secrets have no fixed domain to permute;
they get a keyed digest (of the secret's own length), which links equal values as well.
Of an address with more than 64 characters before the @, the last 64 count.

The key is the setting ``spark.lifetide.pii.key`` unless one is passed; without
either, pseudonyms are made with the key in this file, which anyone can reverse.

The work is one narrow projection: no shuffle, no Python.  The text is cut at
the matches of one pattern; gaps and replaced matches are joined again.

Defined results: null texts stay null with 0 found; values that fail their
check stay as they are and are not counted; empty tables give empty results;
repeated rows and extra columns pass through unchanged (a column named like
``count_col`` is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifetide.llm.common import columns_but, free_name

KEY = "lifetide-demo-key"      # for tests; production sets its own secret
KEY_CONF = "spark.lifetide.pii.key"
ROUNDS = 10

# The shapes, in order of precedence.
SHAPES = {
    # 64 characters before the @ and 127 labels are the standard's limits; they also bound the matcher's work and depth
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}",
    "date": r"\b(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})\b",
    "phone": r"(?:\+\d{1,2} )?\(\d{3}\) \d{3}-\d{4}\b|\b\d{3}-\d{3}-\d{4}\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "ip": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b",
    "card": r"\b(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4})\b",
    "secret": r"\b[0-9a-fA-F]{32,64}\b",
}
PATTERN = "|".join(SHAPES.values())


def _round(key: str, tag: Column, r: Column, x: Column) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(key), tag, r.cast("string"), x.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, m: Column, n: Column, tag: Column, key: str = KEY) -> Column:
    """Struct (a, b) in Z_m x Z_n, permuted under ``key``; ``tag`` keeps the domains apart."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s, r):
        even = F.struct(((s["a"] + _round(key, tag, r, s["b"])) % m).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), ((s["b"] + _round(key, tag, r, s["a"])) % n).alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Luhn sum from the right; ``doubled_first``: the rightmost digit is doubled (a payload without check digit)."""
    def add(acc, i):
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        double = (i % 2 == 1) if doubled_first else (i % 2 == 0)
        return acc + F.when(double, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _pad(x: Column, width: Column | int) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def _pow10(n: Column) -> Column:
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")


def _card(x: Column, key: str) -> Column:
    def with_digits(d):
        width = F.length(d) - 1
        left = (width / 2).cast("int")
        right = width - left
        new = feistel(F.substring(d, F.lit(1), left), F.substring(d, left + 1, right), _pow10(left), _pow10(right),
                      F.concat(F.lit("card"), F.length(d).cast("string")), key)
        payload = _let(new, lambda s: F.concat(_pad(s["a"], left), _pad(s["b"], right)))
        whole = _let(payload, lambda p: F.concat(p, ((F.lit(10) - luhn_sum(p, True) % 10) % 10).cast("string")))
        grouped = _let(whole, lambda w: F.array_join(F.array(*[F.substring(w, 4 * i + 1, 4) for i in range(4)]), "|"))
        grouped = F.replace(grouped, F.lit("|"), F.substring(x, 5, 1))
        return F.when(luhn_sum(d, False) % 10 != 0, x).when(x.rlike(r"\D"), grouped).otherwise(whole)
    return _let(_digits(x), with_digits)


def _phone(x: Column, key: str) -> Column:
    def with_digits(d):
        new = feistel(F.substring(d, -10, 5), F.substring(d, -5, 5), F.lit(100_000), F.lit(100_000), F.lit("phone"), key)
        ten = _let(new, lambda s: F.concat(_pad(s["a"], 5), _pad(s["b"], 5)))
        shape = _let(ten, lambda t: F.when(
            F.contains(x, F.lit("(")),
            F.concat(F.substring_index(x, "(", 1), F.lit("("), F.substring(t, 1, 3), F.lit(") "),
                     F.substring(t, 4, 3), F.lit("-"), F.substring(t, 7, 4)))
            .otherwise(F.concat_ws("-", F.substring(t, 1, 3), F.substring(t, 4, 3), F.substring(t, 7, 4))))
        return shape
    return _let(_digits(x), with_digits)


def _ssn(x: Column, key: str) -> Column:
    area, group, serial = (F.split_part(x, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    valid = (area >= 1) & (area <= 899) & (area != 666) & (group >= 1) & (serial >= 1)
    new = feistel(area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1,
                  F.lit(898), F.lit(99 * 9999), F.lit("ssn"), key)
    made = _let(new, lambda s: F.concat_ws(
        "-", _pad(s["a"] + F.when(s["a"] >= 665, 2).otherwise(1), 3),
        _pad(F.floor(s["b"] / 9999).cast("long") + 1, 2), _pad(s["b"] % 9999 + 1, 4)))
    return F.when(valid, made).otherwise(x)


def _ip(x: Column, key: str) -> Column:
    o = [F.split_part(x, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3, 4)]
    valid = (o[0] <= 255) & (o[1] <= 255) & (o[2] <= 255) & (o[3] <= 255)
    new = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), F.lit("ip"), key)
    made = _let(new, lambda s: F.concat_ws(".", *[v.cast("string") for half in ("a", "b")
                                                  for v in (F.shiftright(s[half], 8), s[half] % 256)]))
    return F.when(valid, made).otherwise(x)


def _date(x: Column, key: str) -> Column:
    iso = F.when(F.contains(x, F.lit("/")),
                 F.concat_ws("-", F.substring(x, 7, 4), F.substring(x, 4, 2), F.substring(x, 1, 2))).otherwise(x)
    # a real calendar day reads back as itself
    day = F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")
    year = F.substring(iso, 1, 4).cast("int")

    def permuted(d):
        since = F.datediff(d, F.lit("1800-01-01").cast("date"))
        cycle = F.floor(since / 146097).cast("long")
        idx = since - cycle * 146097
        new = feistel(F.floor(idx / 773), idx % 773, F.lit(189), F.lit(773), F.lit("date"), key)
        out = _let(new, lambda s: F.date_add(F.lit("1800-01-01").cast("date"),
                                             (cycle * 146097 + s["a"] * 773 + s["b"]).cast("int")))
        return F.when(F.contains(x, F.lit("/")), F.date_format(out, "dd/MM/yyyy")).otherwise(F.date_format(out, "yyyy-MM-dd"))
    return F.when((year >= 1000) & (year < 9800) & day.isNotNull(), _let(day, permuted)).otherwise(x)


def _email(x: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.md5(F.concat_ws(":", F.lit(key), F.lit("email"), F.lower(x))), 1, 12),
                    F.lit("@mail.invalid"))


def _secret(x: Column, key: str) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", F.lit(key), F.lit("secret"), F.lower(x)), 256), F.lit(1), F.length(x))


_KINDS = {"email": _email, "date": _date, "phone": _phone, "ssn": _ssn, "ip": _ip, "card": _card, "secret": _secret}


def session_key(spark) -> str:
    return spark.conf.get(KEY_CONF, KEY)


def pseudonym(x: Column, key: str = KEY) -> Column:
    """The pseudonym of one match of PATTERN (itself, if its value fails its check)."""
    out = None
    for kind, shape in SHAPES.items():
        hit = x.rlike(f"^(?:{shape})$")
        out = F.when(hit, _KINDS[kind](x, key)) if out is None else out.when(hit, _KINDS[kind](x, key))
    return out.otherwise(x)


def pseudonymise(docs: DataFrame, key: str | None = None, col: str = "text", count_col: str | None = "n_found") -> DataFrame:
    """``docs`` with ``col`` rewritten; ``count_col`` (if any): how many values were replaced."""
    key = session_key(docs.sparkSession) if key is None else key
    text, old, made = F.col(col), free_name(docs, "_old"), free_name(docs, "_made")
    found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    new = F.transform(old, lambda x: pseudonym(x, key))
    gaps = F.split(text, PATTERN, -1)
    joined = F.array_join(F.transform(gaps, lambda g, i: F.concat(
        g, F.when(i < F.size(old), F.element_at(made, i + 1)).otherwise(F.lit("")))), "")
    # one pass for the matches, one for their pseudonyms, one for the text; only rows with a match pay for the last two
    hit = F.col(old).isNotNull() & (F.size(old) > 0)
    out = docs.withColumn(old, found)
    out = out.withColumn(made, F.when(hit, new))
    changed = F.when(hit, F.size(F.filter(F.zip_with(old, made, lambda a, b: a != b), lambda c: c))).otherwise(0)
    names = columns_but(docs, *([count_col] if count_col else []))
    cols = [F.when(hit, joined).otherwise(text).alias(col) if c == f"`{col}`" else F.col(c) for c in names]
    extra = [changed.cast("long").alias(count_col)] if count_col else []
    return out.select(*cols, *extra)
