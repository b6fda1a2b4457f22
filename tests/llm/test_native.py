"""Licences, pseudonyms, decontamination and the source mix on hand-made rows."""

import datetime
import random
import re

import pytest
from conftest_llm import frame

from pyspark.sql import functions as F


# ------------------------------------------------------------------ licences
def test_known_texts_have_the_trigger():
    from lifetide.llm.licenses import KNOWN, TRIGGER
    assert all(re.search(TRIGGER, text) for _, text in KNOWN)


def test_license_variants(spark):
    from lifetide.llm.licenses import KNOWN, scan
    mit = dict(KNOWN[:1])["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Some One\n\n" + mit),                       # the whole text, with a copyright line
        (2, mit.upper().replace(",", " ").replace("\n\n", "\n")),           # case, punctuation, line breaks
        (3, "def f():\n    pass\n\n" + mit.replace("\n\n", "\n") + "\n\nmore code"),       # a block
        (4, "intro\nThis work is licenced under the GNU general public licence, version 3.\nAll rights reserved.\n"),
        (5, "LICENSED!! UNDER!! CC!! BY-NC!! 4.0.!!"),
        (6, mit.replace("free of charge", "for a fee")),                    # another text
        (7, "the license of poets"),
    ]
    got = {r["doc_id"]: r for r in scan(frame(spark, rows)).collect()}
    assert [got[i]["licenses"] for i in range(1, 8)] == ["MIT", "MIT", "MIT", "All-Rights-Reserved,GPL-3.0", "CC-BY-NC-4.0", "", ""]
    assert [got[i]["whole_text"] for i in (1, 2, 3, 5)] == ["MIT", "MIT", None, "CC-BY-NC-4.0"]


def wrapped(text, width=70, start=""):
    import textwrap
    return "\n".join((start + line).rstrip() for block in text.split("\n\n") for line in [*textwrap.wrap(block, width), ""]).rstrip()


def test_pasted_texts_keep_their_blank_lines(spark):
    from lifetide.llm.licenses import KNOWN, scan
    full = [(name, text) for name, text in KNOWN if "\n\n" in text]
    assert len(full) == 9
    rows, want = [], {}
    for i, (name, text) in enumerate(full):
        rows += [(3 * i, "def f():\n    pass\n\n" + text + "\n\nmore code\n\nand more"),
                 (3 * i + 1, "/*\n" + wrapped("Copyright (c) 2020 Some One\n\n" + text, 66, " * ") + "\n */\nint main;"),
                 (3 * i + 2, "intro\n\n" + wrapped(text.replace("that the above copyright notice", "that the above\n\ncopyright notice")).replace(
                     "that the above\n\ncopyright notice", "that the above\ncopyright notice") + "\n\nrest")]
        want |= {3 * i: name, 3 * i + 1: name, 3 * i + 2: name}
    got = {r["doc_id"]: r for r in scan(frame(spark, rows)).collect()}
    assert {k: r["licenses"] for k, r in got.items()} == want
    assert all(r["n_units"] == 1 and r["whole_text"] is None for r in got.values())


def test_only_notices_are_dropped(spark):
    from lifetide.llm.licenses import canonical, flat
    keep = ["copyright notice and this permission notice appear in all copies.", "COPYRIGHT HOLDERS BE LIABLE FOR", "copyright owner or"]
    drop = ["Copyright (c) 2020 Some One", " * Copyright 2020", "# copyright Some One", "© 2020 Some One", "(c) 2020 Some One"]
    df = spark.createDataFrame(list(enumerate(keep + drop)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(flat(canonical(F.col("t")))).collect()]
    assert all(got[:len(keep)]) and not any(got[len(keep):])


def test_two_pasted_licences(spark):
    from lifetide.llm.licenses import KNOWN, scan
    known = {text: name for name, text in KNOWN}
    mit, apache = (next(t for t, n in known.items() if n == name and "\n\n" in t) for name in ("MIT", "Apache-2.0"))
    row = scan(frame(spark, [(1, "a\n\nMIT License\n\n" + mit + "\n\n" + apache + "\n\nb\n\n" + mit)])).first()
    assert (row["licenses"], row["n_units"], row["whole_text"]) == ("Apache-2.0,MIT", 3, None)


# ---------------------------------------------------------------- pseudonyms
def luhn(s):
    return sum((d * 2 - 9 * (d > 4)) if i % 2 else d for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


def card(rnd, n=16):
    body = "".join(rnd.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def test_pseudonyms_keep_format_and_links(spark):
    from lifetide.llm.pii import pseudonymise
    rnd = random.Random(1)
    cards = [card(rnd, n) for n in (13, 15, 16, 16, 16, 19)]
    dates = ["2020-02-29", "1999-12-31", "31/01/2001", "9799-12-31", "1000-01-01"]
    ips = ["0.0.0.0", "255.255.255.255", "10.1.2.3"]
    ssn = ["001-01-0001", "899-99-9999", "665-10-1000", "667-10-1000"]
    phones = ["+1 (123) 555-7713", "(123) 555-7713", "123-555-7713"]
    rows = [(i, f"x {v}, {v} y") for i, v in enumerate(cards + dates + ips + ssn + phones, 1)]
    got = {r["doc_id"]: r for r in pseudonymise(frame(spark, rows)).collect()}
    new = []
    for i, (_, text) in enumerate(rows, 1):
        m = re.fullmatch(r"x (.*), (.*) y", got[i]["text"])
        assert m and m[1] == m[2] and got[i]["n_found"] == 2, (text, got[i])
        assert re.sub(r"\d", "9", m[1]) == re.sub(r"\d", "9", text[2:2 + len(m[1])]) or "." in m[1]
        new.append(m[1])
    assert all(luhn(v) for v in new[:len(cards)])
    for v in new[len(cards):len(cards) + len(dates)]:
        datetime.date(*([int(v[6:]), int(v[3:5]), int(v[:2])] if "/" in v else map(int, v.split("-"))))
    assert all(int(o) <= 255 for v in new[11:14] for o in v.split("."))
    assert new[-3] == "+1 " + new[-2] and new[-2].replace("(", "").replace(") ", "-") == new[-1]


def test_invalid_values_stay(spark):
    from lifetide.llm.pii import pseudonymise
    keep = ["4111111111111112", "2021-02-30", "256.1.1.1", "666-12-1234", "000-12-1234", "12345", "0999-01-01", "version 3.", "v1.2"]
    text = " | ".join(keep)
    row = pseudonymise(frame(spark, [(1, text)])).first()
    assert row["text"] == text and row["n_found"] == 0


def test_feistel_is_a_bijection(spark):
    from lifetide.llm.pii import feistel
    df = spark.range(189 * 773).select(feistel(F.floor(F.col("id") / 773), F.col("id") % 773, F.lit(189), F.lit(773), F.lit("t")).alias("p"))
    assert df.select("p.a", "p.b").distinct().count() == 189 * 773
    other = spark.range(100).select(feistel(F.col("id"), F.lit(0), F.lit(189), F.lit(773), F.lit("t"), "another key").alias("p"))
    assert other.subtract(df.limit(100)).count() > 0


# ----------------------------------------------------------- decontamination
ITEM = "When Tom has 5 apples and buys 3 kg of pears for 7 dollars while Tom walks home with Ann and counts all of the fruit"


def found(spark, texts, items=(ITEM,)):
    from lifetide.llm.decontam import contaminated
    bench = spark.createDataFrame(list(enumerate(items, 1)), "item_id long, text string")
    return {r["doc_id"]: r for r in contaminated(frame(spark, list(enumerate(texts, 1))), bench).collect()}


def test_templates_and_slots(spark):
    filler = "some other words that are not in any of the items here at all and go on for a while. "
    other = ITEM.replace("Tom", "Bob").replace("Ann", "Eve").replace("5", "12").replace("3 kg", "9 kg").replace("7", "40")
    mixed = "When Sam has 5 apples and buys 3 kg of pears for 7 dollars while Bob walks home with Ann and counts all of the fruit"
    got = found(spark, [
        filler + ITEM.lower() + filler,          # names in lower case are words, not names
        filler + ITEM + " " + filler,  # the item itself
        filler + other + " " + filler,  # re-parameterised
        filler + mixed + " " + filler,  # Tom is Sam, then Bob
        filler * 3,
        " ".join(ITEM.split()[2:7]),     # five words
    ])
    assert got[2]["exact"] and got[2]["coverage"] > 0.9
    assert not got[3]["exact"] and got[3]["coverage"] > 0.9
    assert set(got) <= {1, 2, 3}


def test_clean_keeps_the_rest(spark):
    from lifetide.llm.decontam import clean
    docs = frame(spark, [(1, ITEM), (2, "nothing of it"), (None, ITEM)], extra=True)
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM)], "item_id long, text string")
    out = clean(docs, bench)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == {2, None}


def test_short_items(spark):
    items = ("What is the capital of France?", "What is 2 + 3?", "法国的首都是哪里？", "Name Five Great Cities Of The Old Roman Empire In Order",
             "", "?!")
    filler = "some other words that go on for a while without any end sign"
    texts = [
        f"{filler} What is the capital of France? {filler}",       # as it is, amid running text
        f"{filler}. what is the\ncapital of FRANCE {filler}",      # case and blanks
        f"{filler}. What is the capital of Spain? {filler}",       # another value
        f"{filler}. What is 2 + 3? {filler}",
        f"{filler}. What is 2 + 4? What is 2 - 3? {filler}",
        "请问法国的首都是哪里呢",                               # no blanks around it
        "请问英国的首都是哪里呢",
        f"{filler} name five great cities of the old Roman empire in order {filler}",
        f"{filler} name five great cities of the old Greek empire in order {filler}",
        "What is the capital of", "", filler]
    from lifetide.llm.decontam import clean, contaminated
    bench = spark.createDataFrame([*enumerate(items, 1), (9, ITEM)], "item_id long, text string")
    docs = frame(spark, [*enumerate(texts, 1), (99, f"{filler}. {ITEM}")])
    got = {(r["doc_id"], r["item_id"]): r for r in contaminated(docs, bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (4, 2), (6, 3), (8, 4), (99, 9)}
    assert all(r["coverage"] == 1 and r["exact"] and r["covered"] == r["item_tokens"] for k, r in got.items() if k[1] != 9)
    assert {r["doc_id"] for r in clean(docs, bench).collect()} == {3, 5, 7, 9, 10, 11, 12}


# ------------------------------------------------------------------ the mix
def fill(sizes):
    """Plain water-filling: clamp, share the rest, until none is above its cap."""
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        target = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if target[s] >= 3 * sizes[s]]
        if not over:
            return {**{s: float(v) for s, v in fixed.items()}, **target}
        fixed.update({s: 3 * sizes[s] for s in over})


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_against_plain_water_filling(spark, seed):
    from lifetide.llm.mixing import mix
    rnd = random.Random(seed)
    sources = ["a", "B", "é", "z", None, "hot"]
    rows = []
    for i in range(300):
        s = "hot" if rnd.random() < 0.4 else rnd.choice(sources[:2 + seed])
        rows.append((i, " ".join("w" for _ in range(rnd.choice((0, 1, 5, 40, 300)))), "en", s))
    out = mix(frame(spark, rows), bucket_rows=8)
    got = out.collect()
    assert sorted(got) == sorted(mix(frame(spark, rows), bucket_rows=8).collect())
    assert sorted(got) == sorted(mix(frame(spark, list(reversed(rows)))).collect())       # buckets change nothing
    size, taken, target = {}, {}, {}
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r["doc_id"]]
        size[s], taken[s], target[s] = size.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"], r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = fill(size)
    for s in size:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - target[s]) <= 1


# --------------------------------------------- texts that wear a matcher out
def test_endless_runs(spark):
    """100,000 capitalised words, numbers with 100,000 parts, a dotted chain of 100,000, blobs of 1 MB: no crash, whole results."""
    from lifetide.llm import decontam, licenses, pii
    blob = "".join(random.Random(3).choice("abcdefXYZ0123456789+._%-") for _ in range(1_000_000))
    rows = [(1, "the " + "Word " * 100_000), (2, "x@" + "b." * 100_000), (3, blob), (4, "mail " + blob + "@example.org now"), (5, "1." * 100_000 + "1"),
            (6, "x@" + "long" * 100_000 + ".com"), (7, "f" * 1_000_000), (8, "licence " + "Word " * 100_000), (9, "licence\n\n" * 20_000),
            (10, "copyright " * 50_000), (11, "a@b.co " * 50_000), (12, "aB" * 300_000)]
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(1, "the " + "Word " * 30 + "went to see some other people in town"), (2, "say 1,000.5 and Two Words"), (3, "zq")],
                                  "item_id long, text string")
    assert decontam.contaminated(docs, bench).count() == 0
    assert len(decontam.clean(docs, bench).collect()) == len(rows)
    made = {r["doc_id"]: r for r in pii.pseudonymise(docs).collect()}
    assert [made[i]["n_found"] for i in (1, 2, 3, 4, 6, 11)] == [0, 0, 0, 1, 1, 50_000]
    assert made[3]["text"] == blob and made[4]["text"].startswith("mail " + blob[:-64]) and made[4]["text"].endswith("@mail.invalid now")
    assert {r["licenses"] for r in licenses.scan(docs).collect()} == {""}


def test_every_spelling_of_a_canonical_text(spark):
    """Whatever stands between the words of a known text, it is found."""
    from lifetide.llm.licenses import KNOWN, scan
    rnd = random.Random(9)
    rows, want = [], {}
    for name, text in KNOWN:
        words = re.findall(r"[^\W_]+", text)
        for gap in (" ", "  ", "-", "\n", " \n", "...", "_", "\t/ "):
            made = "".join(w + gap for w in words)
            made = "".join(c.upper() if rnd.random() < 0.3 else c for c in made)
            if not re.search(r"(?im)^\W*copyright", made):
                rows.append((len(rows), made))
                want[rows[-1][0]] = name
    rows.append((len(rows), "All rights\n(c) 2020 Some One\nreserved."))
    want[rows[-1][0]] = "All-Rights-Reserved"
    got = {r["doc_id"]: r["whole_text"] for r in scan(frame(spark, rows)).collect()}
    assert {k: v for k, v in got.items() if v != want[k]} == {}


def test_known_texts_from_a_table(spark):
    from lifetide.llm.licenses import scan
    known = spark.createDataFrame([("House", "Use it well.\n\nTell your friends.\n\nThat is all."), ("Tiny", "Take it!"), (None, "x y"), ("None", None)],
                                  "license string, text string")
    rows = [(1, "start\n\nUSE it -- well\n\ntell your\nfriends\n\nthat is all\n\nend"), (2, "take it"), (3, "take it away"), (4, None)]
    got = {r["doc_id"]: (r["licenses"], r["whole_text"]) for r in scan(frame(spark, rows), known).collect()}
    assert got == {1: ("House", None), 2: ("Tiny", "Tiny"), 3: ("", None), 4: ("", None)}


def test_key_of_the_session(spark):
    from lifetide.llm import pii
    df = frame(spark, [(1, "call 123-555-7713")])
    plain = pii.pseudonymise(df).first()["text"]
    spark.conf.set(pii.KEY_CONF, "another key")
    try:
        assert pii.pseudonymise(df).first()["text"] not in (plain, "call 123-555-7713")
        assert pii.pseudonymise(df, key=pii.KEY).first()["text"] == plain
    finally:
        spark.conf.unset(pii.KEY_CONF)


def test_shuffled_windows_give_the_same(spark, monkeypatch):
    """A benchmark too large to broadcast: both sides shuffled."""
    from lifetide.llm import decontam
    rnd = random.Random(6)
    words = ["alpha", "beta", "gamma", "Delta", "Omega", "seven", "12", "3.5 kg", "$", "and", "the", "of"]
    texts = [" ".join(rnd.choice(words) for _ in range(40)) for _ in range(40)]
    docs = frame(spark, [(i, texts[i] + " tail " + texts[(i * 7) % 40][:90]) for i in range(30)])
    bench = spark.createDataFrame(list(enumerate(texts[10:])), "item_id long, text string")
    want = sorted(map(tuple, decontam.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontam, "STREAMED", 0)
    assert want and sorted(map(tuple, decontam.contaminated(docs, bench).collect())) == want
    monkeypatch.setattr(decontam, "FOUND_STREAMED", 0)
    assert sorted(map(tuple, decontam.contaminated(docs, bench).collect())) == want
    monkeypatch.setattr(decontam, "STREAMED", 200_000)
    assert sorted(map(tuple, decontam.contaminated(docs, bench).collect())) == want


def test_only_documents_with_hits_are_read_for_placeholders(spark):
    """No filter on the placeholders goes below the join with the ids found (it would read those of every document)."""
    from lifetide.llm import decontam
    docs = frame(spark, [(1, ITEM), (2, "nothing of it " * 20)]).select("doc_id", "text")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    theirs = decontam._marked_windows(bench, "item_id", 8).select("item_id", "_h")
    hits = decontam._windows(docs, "doc_id", 8).join(theirs, "_h", "inner")
    values = decontam._values(decontam._marks_found(docs, hits, theirs, 8), "doc_id", "_d")
    assert {(r["doc_id"], r["_dtype"], r["_dvalue"]) for r in values.collect()} >= {(1, "ǂname", "ǂname⟦tom⟧"), (1, "ǂnum", "ǂnum⟦5⟧")}
    plan = values._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and not [x for x in plan.splitlines() if "Filter" in x and "regexp" in x]


def test_windows_read_their_words_by_place(spark):
    """No slice of the whole array for each window, and every window of a text has its hash."""
    from lifetide.llm import decontam
    texts = ["a b c d e f g h i j", "z a b c d e f g h", "Zz 7 b c d e f g h", "a b c d e f g", "", None]
    docs = frame(spark, list(enumerate(texts))).select("doc_id", "text")
    ours, marked = decontam._windows(docs, "doc_id", 8), decontam._marked_windows(docs, "doc_id", 8)
    got = sorted(map(tuple, ours.select("doc_id", "_p", "_h").collect()))
    assert [r[:2] for r in got] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1)]
    assert got[0][2] == got[4][2] and len({r[2] for r in got}) == 6
    assert sorted(map(tuple, marked.select("doc_id", "_p", "_h").collect())) == got
    assert {(r["doc_id"], r["_p"]): r["_k"] for r in marked.collect()}[(2, 1)] == ["ǂnum⟦7⟧", *[None] * 7]
    short = decontam._plain_windows(docs.select("doc_id", decontam.plain(F.coalesce("text", F.lit(""))).alias("_w")), [2, 9], "doc_id")
    assert short.filter("doc_id = 0").count() == 9 + 2 and short.filter("doc_id > 3").count() == 0
    assert not any("slice(" in d._jdf.queryExecution().optimizedPlan().toString() for d in (ours, marked, short))
