"""The stages on a small corpus: what each keeps, and that decisions take effect."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from orderlens.llm import oracles, queries
from orderlens.llm.queries import ready

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="driver tables not found")


def test_stages_keep_columns_and_drop_copies(spark):
    ready(spark)
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    selected = stages["quality classifier"](spark, docs, ROOT).cache()
    kept = {r["doc_id"] for r in selected.collect()}
    assert all((doc in kept) == bool(q) for doc, q in labels.items())
    lines = stages["line dedup"](spark, selected, ROOT).cache()
    seen = [t for r in lines.collect() for t in r["text"].split("\n") if len(t) >= 20]
    assert len(seen) == len(set(seen))
    single = stages["minhash near-dedup"](spark, lines, ROOT).cache()
    assert {r["doc_id"] for r in single.collect()} <= {r["doc_id"] for r in lines.collect()}
    mixed = stages["mixing"](spark, single, ROOT)
    assert columns == selected.columns == lines.columns == single.columns == mixed.columns


def test_near_duplicate_stage_keeps_one_of_a_group(spark):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(4, text), (2, text), (9, text + " more"), (1, "something else altogether, of six words"), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert {r["doc_id"] for r in left.collect()} == {1, 2, None}


def test_near_duplicate_stage_keeps_one_row_of_a_document(spark):
    text, other = " ".join(f"word{k}" for k in range(40)), "something else altogether, of six words"
    rows = [(4, text, "a"), (2, text, "b"), (2, text, "b"), (2, text, "c"), (7, None, "a"), (7, other, "z"), (7, "", "a"), (8, None, "a"), (8, None, "a")]
    rows += [(None, text, "a"), (None, text, "a"), (None, text.upper(), "b"), (None, other, "a"), (None, None, "a"), (None, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = [tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()]
    again = corpus_pipeline.near_duplicate_stage(spark, docs.repartition(5), "")
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in again.collect()) and again.columns == docs.columns
    named = {r[0]: r[1] for r in got if r[0] is not None}
    assert named == {2: text, 7: other, 8: None} and sum(r[0] is not None for r in got) == 3
    assert sorted((r[1] or "").lower() for r in got if r[0] is None) == sorted(["", "", text, other])


def test_near_duplicate_stage_passes_on_columns_of_any_name(spark):
    text = " ".join(f"word{k}" for k in range(40))
    rows = [(4, text), (2, text), (2, text), (2, "other words"), (1, "something else altogether, of six words"), (None, text), (None, text), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "doc_id as set", "text as row", "map(1, text) as id", "1 as n", "2 as key", "3 as c0", "4 as kept", "5 as Hash", "6 as whole"
    )
    left = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    got = left.collect()
    assert left.columns == docs.columns and all(r["set"] == r["doc_id"] and r["row"] == r["text"] == r["id"][1] for r in got)
    assert Counter(r["doc_id"] for r in got) == {1: 1, 2: 1, None: 2}


def test_run_packs_all_that_is_left(spark):
    pieces = corpus_pipeline.run(spark, ROOT)
    assert pieces.count() > 0
    assert pieces.selectExpr("max(offset + length) as n").first()["n"] <= 1024


@pytest.mark.parametrize("name", list(oracles.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    got, expected = queries.queries()[name](spark, ROOT), con.sql(oracles.oracle_sql()[name])
    columns = expected.columns
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(expected.fetchall())


def test_batches_sent_to_python_are_bounded_by_bytes(spark):
    """Long texts come in more batches, not in larger ones."""
    import pyarrow as pa

    from orderlens.llm.queries import BATCH_BYTES, ready

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    rows = ready(spark).range(6000, numPartitions=1).selectExpr("id", "repeat('x', 2000) AS text")
    found = rows.mapInArrow(sizes, "n bigint, bytes bigint").collect()
    assert sum(r["n"] for r in found) == 6000 and max(r["bytes"] for r in found) < 1.1 * BATCH_BYTES
