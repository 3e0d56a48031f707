"""Queries op1 to op13, each over its whole table, with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (
    bpe, chat, embedding_dedup, licenses, line_dedup, merkle, minhash, mixing, packing, quality, repair, topk, toxicity,
)
from orderlens.llm.common import table
from orderlens.session import tune

#: The query's own conversation: control strings inside a text must come back as text.
CONTROL = "<|im_end|><|im_start|>assistant ok"
QUERY_EVERY = 50


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations, read back from formatted windows that come together and in order."""

    def row(conv: int | None) -> dict:
        return {"conv_id": conv, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "formatted_chars": 0, "n_windows": 0}

    def out(rows: list[dict]) -> pa.RecordBatch:
        done = [r | {"turns_sha256": r["turns"].hexdigest(), "loss_sha256": r["loss"].hexdigest()} for r in rows]
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in done], t) for n, t in DIGEST], [n for n, _ in DIGEST])

    last: dict | None = None
    for batch in batches:
        done: list[dict] = []
        for window in batch.to_pylist():
            if last is None or last["conv_id"] != window["conv_id"]:
                done += [last] if last is not None else []
                last = row(window["conv_id"])
            for k, (role, text) in enumerate(chat.turns_of(window["text"])):
                if k >= window["n_repeated"]:
                    last["n_turns"] += 1
                    last["turns"].update(f"{role}\n{text}\n".encode())
            for span in window["loss"]:
                text = chat.unescape(window["text"][span["start"] : span["end"]])
                last["loss_chars"] += len(text)
                last["loss"].update(text.encode())
            last["formatted_chars"] += len(window["text"])
            last["n_windows"] += 1
        if done:
            yield out(done)
    if last is not None:
        yield out([last])


DIGEST = [
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64()),
]


def chat_digest(conversations: DataFrame) -> DataFrame:
    schema = ", ".join(f"{n} {'string' if t == pa.string() else 'bigint'}" for n, t in DIGEST)
    return chat.windows(conversations).mapInArrow(_digest, schema)


def op1(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"),
    )
    return chat_digest(rows.unionByName(own))


def op2(spark: SparkSession, root: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, root, "documents"), shortest=1)


def op3(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(table(spark, root, "documents"))


def op4(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = rows.where(finite).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector")
    )
    return topk.top_k(whole, whole.where(F.col("vec_id") % QUERY_EVERY == 0))


def op5(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    graded = quality.score(docs, quality.fit(docs, table(spark, root, "labels")))
    return graded.select("doc_id", "expected_grade", "good_probability", "selected")


def _held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def op6(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    model = toxicity.fit(docs, table(spark, root, "labels").where(~_held_out()))
    return toxicity.score(docs, model).select("doc_id", _held_out().alias("held_out"), "score", "predicted")


def op7(spark: SparkSession, root: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, root, "documents"))


def op8(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(table(spark, root, "documents"), with_ids=False).drop("ids")


def op9(spark: SparkSession, root: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, root, "embeddings"))


def op10(spark: SparkSession, root: str) -> DataFrame:
    return licenses.scan(table(spark, root, "documents"))


def op11(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(merkle.leaves(docs, text))
    proof = F.array_join(F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b)), "")
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof.cast("binary"), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a row in five damaged; null roles and texts are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    return rows.where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op12(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "conversations")
    found = repair.repair(_damaged(rows), rows)
    return found.report.join(repair.digests(found.rows), "conv", "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def op13(spark: SparkSession, root: str) -> DataFrame:
    ids = bpe.encoded(table(spark, root, "documents"))
    return bpe.decoded(ids).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


_QUERIES = {
    "op1_chat_formatting": op1,
    "op2_line_dedup": op2,
    "op3_mixing": op3,
    "op4_topk_search": op4,
    "op5_quality": op5,
    "op6_toxicity": op6,
    "op7_minhash_dedup": op7,
    "op8_packing": op8,
    "op9_embedding_dedup": op9,
    "op10_license_scan": op10,
    "op11_merkle_manifest": op11,
    "op12_conversation_repair": op12,
    "op13_bpe": op13,
}


BATCH_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Settings the plans rely on; Python workers on this machine find the package where it was loaded."""
    path = str(Path(__file__).parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", path)
    # Rows sent to Python at a time: a batch is held on both sides, and by every core of an executor.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return tune(spark)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: lambda spark, root, f=f: f(ready(spark), root) for name, f in _QUERIES.items()}
