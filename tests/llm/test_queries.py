"""The registered queries and the pipeline on the smallest tables."""

import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from check import TABLES, compare
from levyline.llm import queries
from levyline.session import written


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, con, sf, name):
    result, _ = compare(spark, con, name, sf, queries.ORACLES[name])
    assert result.startswith("ok") and result != "ok 0", result


def test_held_out_accuracy(spark, con, sf):
    got = {r.doc_id: r for r in queries.op1_language_id(spark, sf).collect()}
    rows = con.execute("SELECT doc_id, lang FROM documents").fetchall()
    held_out = [(d, lang) for d, lang in rows if lang is not None and zlib.crc32(str(d).encode()) % 4 == 2]
    assert len(got) == len(rows) and np.mean([got[d].lang_pred == lang for d, lang in held_out]) >= 0.97


def test_exact_leaks_are_found(spark, con, sf):
    found = {(r.doc_id, r.item_id) for r in queries.op8_decontaminate(spark, sf).collect()}
    assert found >= set(con.execute("SELECT doc_id, item_id FROM documents, benchmark WHERE contains(documents.text, benchmark.text)").fetchall())


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def test_pipeline_stages(spark, con, sf):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "benchmark_leaks", "source_mix", "token_files"]
    docs = queries.table(spark, sf, "documents")
    columns, stages, inputs = docs.columns, dict(corpus_pipeline.STAGES), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        inputs[name] = docs
        docs = written(stage(spark, docs, sf), name)
        assert docs.columns == columns
    text = {r.doc_id: r.text for r in inputs["language"].collect()}
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in {**inputs, "token_files": docs}.items()}
    assert set(ids["near_copies"]) == {d for d, t in text.items() if any(c.isalpha() for c in t)}
    # every document has a kept one that links to it over others, and no two kept ones link
    sets = {d: shingles(text[d], 5) for d in ids["near_copies"]}
    kept = sorted(ids["benchmark_leaks"])
    similar = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert not any(similar(a, b) for i, a in enumerate(kept) for b in kept[i + 1:])
    assert all(any(similar(d, k) for k in ids["near_copies"] if k < d) for d in set(ids["near_copies"]) - set(kept))
    leaks = {d for d, in con.execute("SELECT DISTINCT doc_id FROM documents, benchmark WHERE contains(documents.text, benchmark.text)").fetchall()}
    assert set(ids["source_mix"]) == set(kept) - leaks
    times = {d: ids["token_files"].count(d) for d in ids["source_mix"]}
    assert set(times.values()) <= {0, 1, 2}
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", text[d])) for d in times}
    assert abs(sum(size[d] * n for d, n in times.items()) - 1.5 * sum(size.values())) <= 20 * max(size.values())
    files = stages["token_files"](spark, docs, sf).collect()
    assert sorted(r.doc_id for r in files) == sorted(ids["token_files"])
    assert corpus_pipeline.run(spark, sf).count() == len(files)
