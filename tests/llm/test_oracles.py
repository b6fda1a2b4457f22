"""The operators that SQL can express equal their DuckDB twins; native ones run no Python; all queries are registered."""

import io
import contextlib
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from oracle_check import canon  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from lifetide.llm.oracle import ORACLE  # noqa: E402
from lifetide.llm.queries import QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {f"op{q[2:].split('_')[0]}_" for q in names if q.startswith("op") and q[2].isdigit()}
    assert "pipeline" in names and set(QUERIES) <= names and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SMALL)
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(rel.fetchall(), rel.columns)


def test_twins_state_the_operators(spark):
    """The SQL on texts that the given tables do not have: pasted licences, notices, wrapped spellings, short items, odd texts."""
    import pyarrow as pa
    from conftest_llm import ODD, frame

    from lifetide.llm import decontam, licenses, pii
    mit, apache = (next(t for n, t in licenses.KNOWN if n == name and "\n\n" in t) for name in ("MIT", "Apache-2.0"))
    isc = next(t for n, t in licenses.KNOWN if n == "ISC").replace("that the above copyright", "that the above\ncopyright")
    texts = [*(t for _, t in ODD), "a\n\nMIT License\n\n" + mit + "\n\n" + apache + "\n\nb\n\n" + mit, "/*\n * Copyright (c) 2020 Some One\n *\n * " + isc,
             "All rights  reserved.", "All rights\nreserved", "All Rights-Reserved", "All rights\n(c) 2020 Some One\nreserved.", "copyright\nholders of all",
             "Subject to the terms of the Mozilla Public License, v.\n2.0.", "sub\nlicense", "© x\n\nLicensed under CC BY 4.0.", "copyright",
             "He asked: What is the capital of France? Then 1,000.5 kg and $3.", "what is the CAPITAL of france", "日本の首都は東京です。", "The 12 Monkeys saw Bob Smith",
             "mail a.b@c.example.org or x@y or q@z..de, 1.2.3.4 and 4111 1111 1111 1111, " + "l" * 80 + "@d.io", "Mr Bob Smith of New York paid 3 kg, 5 kg and 3 kg to Ann Lee of Old York",
             "Mr Jim Jones of Big Sur paid 4 kg, 6 kg and 4 kg to Sue Ray of San Jose"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, mit), (3, texts[-1])]
    items = [(1, "What is the capital of France?"), (2, "首都は東京"), (3, "The 12 Monkeys"), (4, "Mr Tom Brown of Los Angeles paid 7 kg, 8 kg and 7 kg to Eve Fox of El Paso"),
             (5, None), (6, ""), (None, "copyright"), (1, "the capital of"), (7, "1,000.5 kg")]
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    con.register("benchmark", pa.table({"item_id": pa.array([r[0] for r in items], pa.int64()), "text": pa.array([r[1] for r in items], pa.string())}))
    for name, df in (("op3_license_scan", licenses.scan(docs)), ("op5_pii_pseudonyms", pii.pseudonymise(docs.select("doc_id", "text"))),
                     ("op8_template_decontam", decontam.contaminated(docs, bench))):
        rel = con.sql(ORACLE[name])
        got = canon([tuple(r) for r in df.collect()], df.columns)
        assert got and got == canon(rel.fetchall(), rel.columns), name


@pytest.mark.parametrize("name", ["op3_license_scan", "op5_pii_pseudonyms", "op8_template_decontam", "op10_source_mix"])
def test_native_operators_run_no_python(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        E.queries()[name](spark, SMALL).explain()
    assert not any(word in out.getvalue() for word in ("Python", "Pandas", "Arrow"))
