import numpy as np
import pytest
from pyspark.sql import functions as F

from levyline.operators import chunks, retrieval
from levyline.schemas import CLEANED
from levyline.sources.tables import markdown_folder
from conftest import frame, filing


def vectors(spark, name, n, seed, copies=False):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, 8)).astype(np.float32)
    if copies:
        data[: n // 3] = data[0]   # a third of the rows are copies
        data[-1] = 0
    return data, spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(data)], f"{name} BIGINT, vector ARRAY<FLOAT>")


def brute(index, queries, k):
    def unit(m):
        lengths = np.linalg.norm(m.astype(float), axis=1, keepdims=True)
        return m.astype(float) / np.where(lengths == 0, 1, lengths)

    scores = np.round(unit(queries) @ unit(index).T, 6)
    out = set()
    for q, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda i: (-row[i], i))[:k]
        out |= {(q, i, rank + 1, row[i]) for rank, i in enumerate(order)}
    return out


@pytest.mark.parametrize("block", [4096, 7])
def test_both_searches_equal_brute_force(spark, block):
    raw_index, index = vectors(spark, "id", 90, 1, copies=True)
    raw_queries, queries = vectors(spark, "q", 20, 2, copies=True)
    want = brute(raw_index, raw_queries, 5)
    a = retrieval.search_index(index.repartition(3), queries, "id", "q", 5, block=block)
    b = retrieval.match_queries(queries.repartition(3), index, "q", "id", 5, block=block)
    for found in (a, b):
        assert {(r["q"], r["id"], r["rank"], r["similarity"]) for r in found.collect()} == want


def test_search_with_no_queries_or_collection(spark):
    _, index = vectors(spark, "id", 5, 1)
    _, queries = vectors(spark, "q", 5, 2)
    assert retrieval.search_index(index, queries.limit(0), "id", "q").count() == 0
    assert retrieval.match_queries(queries, index.limit(0), "q", "id").count() == 0


def test_fallback_only_for_unanswered_queries(spark):
    _, one = vectors(spark, "id", 5, 1)
    _, two = vectors(spark, "id", 6, 3)
    _, queries = vectors(spark, "q", 4, 2)
    both = retrieval.search_with_fallback(queries, one, two, "q", "id", 4, 3)
    assert {r["collection"] for r in both.collect()} == {"first"} and both.count() == 16
    rest = retrieval.search_with_fallback(queries, one.limit(0), two, "q", "id", 4, 3)
    assert {r["collection"] for r in rest.collect()} == {"second"} and rest.count() == 12


def test_embedders_plug_in(spark):
    df = spark.createDataFrame([("a b",), ("",), (None,)], "text STRING")

    def encode(texts):
        return np.array([[len(t), 1.0] for t in texts])

    rows = retrieval.model_embedder(encode)(df, "text", "vector").collect()
    assert rows[0]["vector"] == pytest.approx([3 / 10 ** 0.5, 1 / 10 ** 0.5]) and rows[1]["vector"] == [0.0, 1.0]
    hashed = retrieval.hashing_embedder(16)(df, "text", "vector").collect()
    assert len(hashed[0]["vector"]) == 16 and np.linalg.norm(hashed[0]["vector"]) == pytest.approx(1)


def test_record_text_and_payload(spark):
    df = frame(spark, [filing("a", province="GAUTENG", taxable_income=12345678.5, employment_type=None, is_fraud=True)], CLEANED)
    text = df.select(retrieval.record_text().alias("t")).first()["t"]
    assert text == "Province GAUTENG income 12345678.5 employment unknown status full_time filing amended fraud True"
    row = df.select(*retrieval.payload_columns(df)).first()
    assert row["employment_type"] == "UNKNOWN" and row["risk_score"] == 0.0 and row["processed_at"] is None


def test_new_records(spark):
    records = spark.createDataFrame([(x,) for x in "abcd"], "application_id STRING")
    points = retrieval.new_records(records, records.limit(0).withColumn("point_id", F.lit(""))).where("application_id IN ('a', 'c')")
    assert sorted(r["application_id"] for r in retrieval.new_records(records, points).collect()) == ["b", "d"]


def test_evidence(spark):
    hits = spark.createDataFrame(
        [("q", 1, 0.99, True, "a"), ("q", 2, 0.9, True, "b"), ("q", 3, 0.86, True, "c"), ("q", 4, 0.86, False, "d"),
         ("r", 1, 0.8500, True, "e")], "q STRING, rank INT, similarity DOUBLE, is_fraud BOOLEAN, application_id STRING")
    got = {r["q"]: r for r in retrieval.similar_case_evidence(hits, "q").collect()}
    assert (got["q"]["similar_fraud"], got["q"]["risk"], got["q"]["shown_cases"]) == (3, "ELEVATED", "a, b, c")
    assert (got["r"]["similar_fraud"], got["r"]["risk"]) == (0, "UNAVAILABLE")


def test_context_text(spark):
    questions = spark.createDataFrame([(1,), (2,), (3,)], "q INT")
    hits = spark.createDataFrame(
        [(1, 2, "b.md", "S2", "x", "internal", None, "two"), (1, 1, "a.md", "S1", None, None, None, "one"),
         (2, 1, None, "S9", None, None, "Act", "law")],
        "q INT, rank INT, file STRING, section STRING, source STRING, status STRING, source_doc STRING, text STRING")
    got = {r["q"]: r["context"] for r in retrieval.kb_context(questions, hits, "q").collect()}
    assert got[1] == ("[Source 1: a.md - S1 | origin: n/a | status: n/a]\none\n\n"
                      "[Source 2: b.md - S2 | origin: x | status: internal]\ntwo")
    assert got[2] == "[Source 1: Act §S9]\nlaw" and got[3] == retrieval.NO_CONTEXT


def test_markdown_sections(spark, tmp_path):
    (tmp_path / "README.md").write_text("## No\nSource: x\n")
    (tmp_path / "b.md").write_text("no sections")
    (tmp_path / "a.md").write_text(
        "# T\n\nAuthority:  INTERNAL \n\n## First one \n\nSource: agents ; x\nStatus: internal\n\nBody ## not a heading\n\n## Second")
    rows = chunks.with_point_ids(chunks.section_chunks(markdown_folder(spark, str(tmp_path)))).orderBy("position").collect()
    assert [(r["file"], r["section"], r["source"], r["status"], r["authority"]) for r in rows] == [
        ("a.md", "First one", "agents ; x", "internal", "INTERNAL"), ("a.md", "Second", "", "", "INTERNAL")]
    assert rows[0]["text"] == "First one\nSource: agents ; x\nStatus: internal\n\nBody ## not a heading"
    assert rows[1]["text"] == "Second\n" and rows[0]["chunk_id"] == "a.md::First one"


def test_numbers_keep_their_digits_at_every_size(spark):
    from decimal import Decimal

    from levyline.operators.retrieval import plain_number

    values = [0.0, 1.5, -2.25, 9999999.0, 1e7, 12345678.9, -12345678.123456789, 123456789012.25, 1.5e24, 1e25, -3.25e30, 1.7e308, 1e-4, -1.25e-9, None]
    got = [r.x for r in spark.createDataFrame([(v,) for v in values], "v double").select(plain_number("v").alias("x")).collect()]

    def plain(v):
        text = format(Decimal(repr(v)), "f")
        return text if "." in text else text + ".0"

    assert got == [plain(v) if v is not None else "0" for v in values]
