"""The stages against brute force, and the registered queries against SQL."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from nutrilake.llm import jaccard, queries, toxicity
from nutrilake.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data absent")


@needs_data
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    out = queries.queries()[name](spark, SF)
    assert sorted(out.columns) == sorted(names)
    order = sorted(names)
    got = sorted(repr(tuple(r[c] for c in order)) for r in out.collect())
    want = sorted(repr(tuple(r[names.index(c)] for c in order)) for r in cursor.fetchall())
    assert got == want


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "source_mix", "packing"]


@needs_data
def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SF).cache()
        rows = out.collect()
        if name == "packing":
            tokens = sum(r.length for r in rows)
            assert len({r.sequence_id for r in rows}) <= 1.05 * tokens / 2048 + 2
            continue
        assert out.columns == columns
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            score = {r.doc_id: r.score for r in toxicity.fit_toxicity(at, labels).score(at).collect()}
            assert {r.doc_id for r in rows} == {d for d, s in score.items() if s < toxicity.THRESHOLD}
        if name == "line_dedup":
            assert {r.doc_id for r in rows} == {r.doc_id for r in at.collect()}
            assert all(r.n_chars == len(r.text) <= len(before[r.doc_id].text or "") for r in rows)
        if name == "near_duplicates":
            found = jaccard.similar_documents(at).collect()
            assert {r.doc_id for r in rows} == {r.component_id for r in found} and len(rows) == len({r.component_id for r in found})
        if name == "source_mix":
            texts = {r.doc_id: r.text for r in at.collect()}
            counts = {}
            for r in rows:
                assert r.text == texts[r.doc_id]
                counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
            assert max(counts.values()) <= 3
        at = out


@needs_data
def test_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    again = corpus_pipeline.run(spark, SF).collect()
    order = lambda rs: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rs)
    assert order(rows) == order(again)
