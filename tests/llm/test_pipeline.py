"""The pipeline against its stages on the driver, and the SQL of the queries that have one."""

import random
import re

import duckdb
import pytest

import corpus_pipeline
from opstelemetry.llm import decontam, queries
from tests.llm.test_documents import base_spans, groups, measures

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for name in ("documents", "benchmark", "conversations", "embeddings"):
        out.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return out


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, con, name):
    found = queries.queries()[name](spark, SF)
    columns = sorted(found.columns)
    want = con.sql(f"select {', '.join(columns)} from ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(repr(tuple(r)) for r in found.select(*columns).collect()) == sorted(map(repr, want))


def test_pipeline(spark, con):
    rows = con.sql("select doc_id, text from documents").fetchall()
    kept = []
    for r in rows:
        n, chars, symbols, dup, repeat = measures(r[1])
        lines = [x for x in (r[1] or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        bad = n < 20 or 100 * repeat > 30 * n or 4 * symbols > n or 4 * (r[1] or "").count("!") > n
        if not (bad or 2 * dup > len(lines) or chars < 2 * n or chars > 20 * n):
            kept.append(r)
    kept = [r for r, least in zip(kept, groups(kept)[1], strict=True) if r[0] == least]
    hits = {r[0] for r in con.sql(f"select doc_id from ({queries.oracle_sql()['op7_benchmark_decontamination']})").fetchall()}
    want = {r[0]: r for r in kept if r[0] not in hits}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    final = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(final) == set(want)
    assert not any(base_spans(t) for t in final.values())
    for key, text in final.items():
        assert text == want[key][1] or "[SECRET]" in text
    mix = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in mix} <= set(want) and all(r["taken"] > 0 for r in mix)


def test_stages_remove_rows_not_ids(spark):
    rnd = random.Random(3)
    one, two, three, four, five = (" ".join(str(rnd.random()) for _ in range(40)) for _ in range(5))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    # a null-id copy of a numbered row, null ids of two groups, and one id with two texts, one of them a copy
    rows = [(1, one), (None, one), (None, two), (None, three), (None, three), (2, four), (2, one), (3, five), (3, five)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema).repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, SF)
    assert kept.columns == docs.columns
    want = [(1, one), (None, two), (None, three), (2, four), (3, five)]
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(repr, want))
    benchmark = spark.createDataFrame([(7, two), (8, four)], "item_id long, text string")
    clean = decontam.clean(docs, benchmark)
    want = [r for r in rows if r[1] not in (two, four)]
    assert clean.columns == docs.columns
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in clean.collect()))) == sorted(map(repr, want))
