"""DuckDB SQL of the operators that SQL can express (the others: tests/llm)."""

ORACLE: dict[str, str] = {}

_WORD = r"[^\x20\x09-\x0D]+"

# every set of clamped sources is tried as a prefix by cap / weight, without a running level
ORACLE["op10_source_mix"] = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM sized GROUP BY source),
placed AS (
  SELECT *, source_size * 3 AS cap, row_number() OVER (ORDER BY (source_size * 3)::DOUBLE / w, source NULLS LAST) AS pos FROM per),
levels AS (
  SELECT a.pos, (SELECT sum(source_size) FROM per) - coalesce(sum(b.cap), 0) AS rest,
         (SELECT sum(w) FROM per) - coalesce(sum(b.w), 0) AS rest_w
  FROM placed a LEFT JOIN placed b ON b.pos < a.pos GROUP BY a.pos),
first_free AS (
  SELECT l.pos, l.rest, l.rest_w FROM levels l JOIN placed p USING (pos)
  WHERE p.cap * l.rest_w > l.rest * p.w ORDER BY l.pos LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN f.pos IS NULL OR p.pos < f.pos THEN cap::DOUBLE
              ELSE (f.rest * p.w)::DOUBLE / f.rest_w::DOUBLE END AS target
  FROM placed p LEFT JOIN first_free f ON true),
ordered AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('20240607:' || coalesce(s.doc_id::VARCHAR, '')), s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, round(target - whole * source_size)::BIGINT - before)))::BIGINT AS taken
FROM ordered
"""


def _pii_sql() -> str:
    """Matches as rows, one common table per Feistel round, texts put together again by position."""
    from lifetide.llm.pii import KEY, PATTERN, ROUNDS, SHAPES
    kinds = " ".join(f"WHEN regexp_full_match(x, '{p}') THEN '{k}'" for k, p in SHAPES.items())
    digits = "regexp_replace(x, '[^0-9]', '', 'g')"
    luhn = ("list_sum([CASE WHEN i % 2 = {odd} THEN CASE WHEN d::INT > 4 THEN d::INT * 2 - 9 ELSE d::INT * 2 END ELSE d::INT END "
            "FOR d, i IN string_split(reverse({s}), '')])")
    octet = "string_split(x, '.')[{}]::INT"
    part = "string_split(x, '-')[{}]::INT"
    rounds, last = [], "domain"
    for r in range(ROUNDS):
        own, other, mod = ("a", "b", "m") if r % 2 == 0 else ("b", "a", "n")
        rounds.append(f"r{r} AS (SELECT * REPLACE (({own} + ('0x' || substr(md5('{KEY}:' || tag || ':{r}:' || {other}), 1, 15))::BIGINT) "
                      f"% {mod} AS {own}) FROM {last})")
        last = f"r{r}"
    return f"""
WITH cut AS (
  SELECT row_number() OVER () AS rid, doc_id, text, regexp_extract_all(text, '{PATTERN}') AS old,
         regexp_split_to_array(text, '{PATTERN}') AS gaps FROM documents),
found AS (SELECT rid, unnest(old) AS x, generate_subscripts(old, 1) AS pos FROM cut),
kinds AS (SELECT *, CASE {kinds} END AS kind, {digits} AS d,
  CASE WHEN contains(x, '/') THEN substr(x, 7, 4) || '-' || substr(x, 4, 2) || '-' || substr(x, 1, 2) ELSE x END AS iso FROM found),
checked AS (SELECT *, try_cast(CASE WHEN kind = 'date' THEN iso END AS DATE) AS day,
  CASE kind WHEN 'card' THEN {luhn.format(odd=0, s="d")} % 10 = 0
    WHEN 'ip' THEN list_max([o::INT FOR o IN string_split(x, '.')]) <= 255
    WHEN 'ssn' THEN {part.format(1)} BETWEEN 1 AND 899 AND {part.format(1)} <> 666 AND {part.format(2)} >= 1 AND {part.format(3)} >= 1
    WHEN 'date' THEN try_cast(iso AS DATE) IS NOT NULL AND substr(iso, 1, 4)::INT BETWEEN 1000 AND 9799
    ELSE true END AS valid, (length(d) - 1) // 2 AS half FROM kinds),
numbered AS (SELECT *, date_diff('day', DATE '1800-01-01', day) AS since FROM checked),
domain AS (
  SELECT *, floor(since / 146097)::BIGINT AS cyc,
    CASE kind WHEN 'card' THEN 'card' || length(d) ELSE kind END AS tag,
    (CASE kind WHEN 'card' THEN substr(d, 1, half)::BIGINT WHEN 'phone' THEN substr(d, length(d) - 9, 5)::BIGINT
      WHEN 'ip' THEN {octet.format(1)} * 256 + {octet.format(2)}
      WHEN 'ssn' THEN {part.format(1)} - CASE WHEN {part.format(1)} > 666 THEN 2 ELSE 1 END
      WHEN 'date' THEN (since - floor(since / 146097)::BIGINT * 146097) // 773 ELSE 0 END)::BIGINT AS a,
    (CASE kind WHEN 'card' THEN substr(d, half + 1, length(d) - 1 - half)::BIGINT WHEN 'phone' THEN substr(d, length(d) - 4, 5)::BIGINT
      WHEN 'ip' THEN {octet.format(3)} * 256 + {octet.format(4)}
      WHEN 'ssn' THEN ({part.format(2)} - 1) * 9999 + {part.format(3)} - 1
      WHEN 'date' THEN (since - floor(since / 146097)::BIGINT * 146097) % 773 ELSE 0 END)::BIGINT AS b,
    (CASE kind WHEN 'card' THEN 10 ** half WHEN 'phone' THEN 100000 WHEN 'ip' THEN 65536 WHEN 'ssn' THEN 898 WHEN 'date' THEN 189 ELSE 1 END)::BIGINT AS m,
    (CASE kind WHEN 'card' THEN 10 ** (length(d) - 1 - half) WHEN 'phone' THEN 100000 WHEN 'ip' THEN 65536 WHEN 'ssn' THEN 989901 WHEN 'date' THEN 773 ELSE 1 END)::BIGINT AS n
  FROM numbered),
{", ".join(rounds)},
shown AS (SELECT *, CASE kind
    WHEN 'card' THEN lpad(a::VARCHAR, half::INT, '0') || lpad(b::VARCHAR, length(d)::INT - 1 - half::INT, '0')
    WHEN 'phone' THEN lpad(a::VARCHAR, 5, '0') || lpad(b::VARCHAR, 5, '0') END AS t FROM {last}),
closed AS (SELECT *, CASE WHEN kind = 'card' THEN t || ((10 - {luhn.format(odd=1, s="t")} % 10) % 10)::VARCHAR ELSE t END AS u FROM shown),
made AS (SELECT rid, pos, x, CASE WHEN NOT valid THEN x ELSE CASE kind
    WHEN 'card' THEN CASE WHEN x = d THEN u ELSE concat_ws(substr(x, 5, 1), substr(u, 1, 4), substr(u, 5, 4), substr(u, 9, 4), substr(u, 13, 4)) END
    WHEN 'phone' THEN CASE WHEN contains(x, '(') THEN string_split(x, '(')[1] || '(' || substr(u, 1, 3) || ') ' || substr(u, 4, 3) || '-' || substr(u, 7, 4)
      ELSE substr(u, 1, 3) || '-' || substr(u, 4, 3) || '-' || substr(u, 7, 4) END
    WHEN 'ip' THEN concat_ws('.', a // 256, a % 256, b // 256, b % 256)
    WHEN 'ssn' THEN lpad((a + CASE WHEN a >= 665 THEN 2 ELSE 1 END)::VARCHAR, 3, '0') || '-' || lpad((b // 9999 + 1)::VARCHAR, 2, '0')
      || '-' || lpad((b % 9999 + 1)::VARCHAR, 4, '0')
    WHEN 'date' THEN CASE WHEN contains(x, '/') THEN strftime(DATE '1800-01-01' + (cyc * 146097 + a * 773 + b)::INT, '%d/%m/%Y')
      ELSE strftime(DATE '1800-01-01' + (cyc * 146097 + a * 773 + b)::INT, '%Y-%m-%d') END
    WHEN 'email' THEN 'u' || substr(md5('{KEY}:email:' || lower(x)), 1, 12) || '@mail.invalid'
    WHEN 'secret' THEN substr(sha256('{KEY}:secret:' || lower(x)), 1, length(x)) END END AS y FROM closed),
per_doc AS (SELECT rid, list(y ORDER BY pos) AS new, sum((x <> y)::INT)::BIGINT AS n FROM made GROUP BY rid)
SELECT c.doc_id, CASE WHEN p.rid IS NULL THEN c.text ELSE
    list_aggregate([g || coalesce(p.new[i], '') FOR g, i IN c.gaps], 'string_agg', '') END AS text, coalesce(p.n, 0) AS n_found
FROM cut c LEFT JOIN per_doc p USING (rid)
"""


ORACLE["op5_pii_pseudonyms"] = _pii_sql()


def _re2(replacement: str) -> str:
    return replacement.replace("$", "\\")


def _re2_pattern(pattern: str) -> str:
    """Possessive groups as greedy ones (the same here, and this engine does not recurse)."""
    return pattern.replace(")*+", ")*")


def _template_sql(text: str, with_values: bool) -> str:
    from lifetide.llm.decontam import STEPS
    for pattern, marked, bare in STEPS:
        text = f"regexp_replace({text}, '{_re2_pattern(pattern)}', '{_re2(marked if with_values else bare)}', 'g')"
    return f"lower({text})"


# scripts without blanks count by character
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
_PLAIN = r"[\p{L}\p{M}]+|\d+(?:[.,]\d+)*|\p{N}|[$€£%°+*/=<>^×÷−-]"


def _decontam_sql() -> str:
    """Joins the windows' own words instead of hashes; looks short items up as strings."""
    from lifetide.llm.decontam import MIN_COVERAGE, TOKEN_MARKED, WINDOW
    plain = f"regexp_extract_all(regexp_replace(lower(coalesce(text, '')), '([{_UNSPACED}])', ' \\1 ', 'g'), '{_PLAIN}')"
    tok = "list_filter(string_split_regex({}, '[^\\p{{L}}]+'), lambda t: t <> '')".format(_template_sql("coalesce(text, '')", False))
    marked = f"regexp_extract_all({_template_sql("coalesce(text, '')", True)}, '{TOKEN_MARKED}')"

    def side(name: str, key: str, short: str) -> str:
        return f"""
{short}_tokens AS (SELECT {key}, {tok} AS t FROM {name}),
{short}_windows AS (SELECT DISTINCT {key}, len(t) AS n, p - 1 AS p, array_to_string(t[p:p + {WINDOW - 1}], ' ') AS w
  FROM (SELECT {key}, t, unnest(range(1, len(t) - {WINDOW - 2})) AS p FROM {short}_tokens WHERE len(t) >= {WINDOW} AND {key} IS NOT NULL)),
{short}_marks AS (SELECT {key}, unnest(m) AS v, generate_subscripts(m, 1) - 1 AS p FROM (SELECT {key}, {marked} AS m FROM {name})),
{short}_values AS (SELECT DISTINCT {key}, p, string_split(v, '⟦')[1] AS type, v FROM {short}_marks WHERE contains(v, '⟦'))"""
    return f"""
WITH {side("documents", "doc_id", "d")}, {side("benchmark", "item_id", "i")},
hits AS (SELECT DISTINCT d.doc_id, i.item_id, i.n, i.p, d.p - i.p AS shift FROM d_windows d JOIN i_windows i USING (w)),
covered AS (SELECT DISTINCT doc_id, item_id, n, shift, unnest(range(p, p + {WINDOW})) AS pos FROM hits),
slots AS (SELECT c.doc_id, c.item_id, shift, iv.type, iv.v, min(dv.v) AS lo, max(dv.v) AS hi
  FROM covered c JOIN i_values iv ON c.item_id = iv.item_id AND c.pos = iv.p
  JOIN d_values dv ON c.doc_id = dv.doc_id AND c.pos + c.shift = dv.p AND iv.type = dv.type GROUP BY ALL),
verdict AS (SELECT doc_id, item_id, shift, bool_and(lo = hi) AS consistent, bool_and(lo = v AND hi = v) AS same FROM slots GROUP BY ALL),
kept AS (SELECT c.doc_id, c.item_id, pos, max(n) AS n, bool_or(coalesce(same, true)) AS same
  FROM covered c LEFT JOIN verdict USING (doc_id, item_id, shift) WHERE coalesce(consistent, true) GROUP BY 1, 2, 3),
windowed AS (
  SELECT doc_id, item_id, count(*) AS covered, max(n)::BIGINT AS item_tokens, count(*)::DOUBLE / max(n)::DOUBLE AS coverage, bool_and(same) AS exact
  FROM kept GROUP BY doc_id, item_id HAVING count(*)::DOUBLE / max(n)::DOUBLE >= {MIN_COVERAGE}),
short AS (
  SELECT DISTINCT item_id, len({tok})::BIGINT AS n, '|' || array_to_string({plain}, '|') || '|' AS w FROM benchmark
  WHERE item_id IS NOT NULL AND len({tok}) BETWEEN 1 AND {WINDOW - 1} AND len({plain}) > 0),
written AS (
  SELECT doc_id, '|' || array_to_string({plain}, '|') || '|' AS w FROM documents WHERE doc_id IS NOT NULL AND (SELECT count(*) FROM short) > 0),
found AS (
  SELECT * FROM windowed
  UNION ALL SELECT doc_id, item_id, max(n), max(n), 1.0::DOUBLE, true FROM written d JOIN short s ON contains(d.w, s.w) GROUP BY doc_id, item_id),
best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY coverage DESC, covered DESC, item_tokens DESC, exact DESC) AS r FROM found)
SELECT doc_id, item_id, covered, item_tokens, coverage, exact FROM best WHERE r = 1
"""


def _license_sql() -> str:
    """Looks the canonical texts themselves up, in a list of values; no trigger words."""
    from lifetide.llm.licenses import KNOWN, SPELLINGS, wrapped
    kept = "zqkept"            # stands before lines that begin with "copyright" and are no notice
    words = "notice|holder|owner|licen[cs]e|law|statement"

    def canon(text: str) -> str:
        out = f"regexp_replace(lower({text}), '\\r\\n?', chr(10), 'g')"
        out = f"regexp_replace({out}, '(^|\\n)([^a-z0-9\\n]*)copyright([a-z]|[^a-z0-9]+(?:{words}))', '\\1\\2{kept}copyright\\3', 'g')"
        out = f"regexp_replace({out}, '(^|\\n)[^a-z0-9\\n]*(?:copyright|©|\\(c\\) )[^\\n]*', '\\1', 'g')"
        out = f"regexp_replace(replace({out}, '{kept}copyright', 'copyright'), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
        for pattern, same in SPELLINGS:
            out = f"regexp_replace({out}, '{wrapped(pattern)}', '{_re2(same)}', 'g')"
        return out

    flat = "trim(regexp_replace({}, '[ \\n]+', ' ', 'g'))"
    values = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in KNOWN)
    blocks = f"list_filter([{flat.format('x')} FOR x IN string_split_regex(c, '\\n *\\n')], lambda x: x <> '')"
    paragraphs = "list_filter(string_split_regex(c, '\\n *\\n'), lambda x: contains(trim(x), chr(10)))"
    lines = "string_split(c, chr(10))"
    return f"""
WITH known AS (SELECT DISTINCT license, {flat.format(canon("t"))} AS body FROM (VALUES {values}) v(license, t)),
known_blocks AS (SELECT max(len({blocks})) AS most FROM (SELECT {canon("t")} AS c FROM (VALUES {values}) v(license, t))),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {canon("coalesce(text, '')")} AS c FROM documents),
cut AS (SELECT rid, doc_id, {blocks} AS b FROM docs),
ends AS (SELECT rid, doc_id, b, unnest(range(1, len(b) + 1)) AS e FROM cut),
units AS (
  SELECT rid, doc_id, true AS whole, -1 AS place, {flat.format("c")} AS body FROM docs
  UNION ALL SELECT rid, doc_id, false, i * 3, {flat.format("p")} FROM (SELECT rid, doc_id, unnest({paragraphs}) AS p, generate_subscripts({paragraphs}, 1) AS i FROM docs)
  UNION ALL SELECT rid, doc_id, false, i * 3 + 1, {flat.format("p")} FROM (SELECT rid, doc_id, unnest({lines}) AS p, generate_subscripts({lines}, 1) AS i FROM docs)
  UNION ALL SELECT rid, doc_id, false, e * 3 + 2, array_to_string(b[e - n + 1:e], ' ')
    FROM (SELECT *, unnest(range(2, least((SELECT most FROM known_blocks), e) + 1)) AS n FROM ends WHERE e > 1)),
found AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(DISTINCT CASE WHEN NOT whole THEN (rid, place) END) AS n_units,
  min(CASE WHEN whole THEN license END) AS whole_text FROM units JOIN known USING (body) GROUP BY doc_id)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(n_units, 0) AS n_units, whole_text FROM docs d LEFT JOIN found f USING (doc_id)
"""


ORACLE["op8_template_decontam"] = _decontam_sql()
ORACLE["op3_license_scan"] = _license_sql()

# every pair of vectors
ORACLE["op11_maxscore_search"] = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored AS (
  SELECT DISTINCT q.vec_id AS query_id, v.vec_id, coalesce(list_sum([coalesce(z[1] * z[2], 0) FOR z IN list_zip(q.c, v.c)]), 0)::BIGINT AS score
  FROM v q JOIN v ON v.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""
