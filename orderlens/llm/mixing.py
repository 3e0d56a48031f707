"""Mixing sources to target weights, in fixed-length blocks. DataFrame functions only.

Each source's documents, one after another, are a stream of words cut into blocks of BLOCK words. A
source with target t and s words gets t / s passes over its blocks as slots, so its share of the
output is its target to within a block. A seeded draw gives the sources' counts in every output shard,
multinomial over the shards for each source's total, which is fixed; their running sums over the shards
are the range of the source's slots that a shard takes. Slot g of a source is in pass g div n, and within a pass a pseudorandom permutation of the n blocks maps
it to its block: no block comes twice before all have come once. Slots then meet their blocks on
(source, block). Nothing is sorted or shuffled as a whole; a hot source is cut into chunks by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import WORD
from orderlens.session import materialize

BLOCK = 128
#: Weights of sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: No source is taken more often than this.
PASSES = 3
#: Parts that a source's stream is summed in, and slots a task row unfolds.
CHUNKS = 1024
SLOTS = 4096
#: Slots of an output shard, on average.
SHARD = 65536
ROUNDS = 8
SEED = 17


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) with source_no and target; rows are sources.

    The total is shared by weight; what a source cannot take beyond PASSES times its size goes to the
    others by weight. So a target is the smaller of that cap and level * weight, and the level follows
    from the sources in the order in which they meet their caps.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.pmod(F.col("source_no"), F.lit(len(WEIGHTS))) + 1).cast("int"))
    rows = sizes.withColumn("source_no", F.row_number().over(named) - 1).withColumn("weight", weight)
    rows = rows.withColumn("cap", F.col("source_size") * PASSES)
    full = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before, everything = full.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_ = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", left / open_)
    # The first source whose cap the level does not reach sets the level for all after it.
    rows = rows.withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
    level = F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), "source_no", "level"))).over(everything)["level"]
    target = F.coalesce(F.least(F.col("cap").cast("double"), level * F.col("weight")), F.col("cap").cast("double"))
    return rows.withColumn("target", target).select("source", "source_no", "source_size", "target")


def permuted(at: Column, n: Column, *key: Column) -> Column:
    """The place of ``at`` in a pseudorandom permutation of 0..n-1 that depends on the key.

    Swap or not: every round pairs each number with one other and swaps the pair or leaves it.
    """

    def swap(x: Column, turn: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), turn, *key), n) + n - x, n)
        return F.when(F.pmod(F.xxhash64(F.lit(SEED + 1), turn, F.greatest(x, partner), *key), F.lit(2)) == 0, x).otherwise(partner)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), at, swap)


def streams(docs: DataFrame) -> DataFrame:
    """Rows with size and first_word (where the row starts in its source's stream)."""
    chunk = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(CHUNKS))
    rows = docs.withColumn("chunk", chunk)
    sums = rows.groupBy("source", "chunk").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("chunk")) - F.col("n")
    offsets = sums.select(F.col("source").alias("s"), F.col("chunk").alias("c"), before.alias("before"))
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "size", "text_key")
    rows = rows.withColumn("inside", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = rows.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    return rows.withColumn("first_word", F.col("before") + F.col("inside")).drop("chunk", "inside", "before", "s", "c")


def _unfolded(rows: DataFrame, first: str, until: str) -> DataFrame:
    """``rows`` with ``slot``: one row for each number from ``first`` to before ``until``, in several tasks."""
    spans = rows.where(F.col(until) > F.col(first))
    spans = spans.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(until) - F.col(first) - 1) / SLOTS))))
    # A number of partitions keeps adaptive execution from putting these few rows into one task: they unfold.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = spans.repartition(tasks, "source_no", first, "part")
    start = F.col(first) + F.col("part") * SLOTS
    return spans.withColumn("slot", F.explode(F.sequence(start, F.least(start + SLOTS, F.col(until)) - 1))).drop("part")


def shard_counts(sources: DataFrame) -> DataFrame:
    """(source_no, n, shard, first, until): the slots of a source, of n blocks, that each output shard takes.

    Every slot of a source's total draws one of the shards, which all are equally likely, so the counts
    until - first are a multinomial draw; shards that a source's draw leaves empty have no row.
    """
    n = F.ceil(F.col("source_size") / BLOCK).cast("bigint")
    takes = F.least(F.rint(F.col("target") * n / F.col("source_size")).cast("bigint"), n * PASSES)
    rows = sources.where("source_size > 0").select("source_no", n.alias("n"), F.lit(0).cast("bigint").alias("zero"), takes.alias("total"))
    rows = rows.withColumn("shards", F.ceil(F.sum("total").over(Window.partitionBy()) / SHARD).cast("bigint"))
    shard = F.pmod(F.xxhash64(F.lit(SEED + 2), "source_no", "slot"), F.greatest(F.col("shards"), F.lit(1)))
    drawn = _unfolded(rows, "zero", "total").groupBy("source_no", "n", shard.alias("shard")).agg(F.count("*").alias("taken"))
    until = F.sum("taken").over(Window.partitionBy("source_no").orderBy("shard"))
    return drawn.select("source_no", "n", "shard", (until - F.col("taken")).alias("first"), until.alias("until"))


def slots(sources: DataFrame) -> DataFrame:
    """(source_no, slot, pass, block, shard) for every slot of the mix; ``sources`` as from targets()."""
    rows = _unfolded(shard_counts(sources), "first", "until").withColumn("pass", F.floor(F.col("slot") / F.col("n")))
    block = F.coalesce(permuted(F.pmod("slot", "n"), F.col("n"), F.col("source_no"), F.col("pass")), F.lit(0).cast("bigint"))
    return rows.select("source_no", "slot", "pass", block.alias("block"), "shard")


def pieces(rows: DataFrame) -> DataFrame:
    """One row for each block that a row of text reaches into: block, from_word (in the row) and words."""
    end = F.col("first_word") + F.col("size")
    reach = F.sequence(F.floor(F.col("first_word") / BLOCK), F.floor((end - 1) / BLOCK))
    cut = rows.where("size > 0").withColumn("block", F.explode(reach))
    start = F.greatest(F.col("first_word"), F.col("block") * BLOCK)
    words = F.least(end, (F.col("block") + 1) * BLOCK) - start
    return cut.withColumn("from_word", start - F.col("first_word")).withColumn("words", words)


def _sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and text_key of every row, which is all that the plan needs of it."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count("text").alias("size"), F.xxhash64("text").alias("text_key"),
    )


def _plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed rows in their streams, with their source's numbers; and the sources."""
    sized = materialize(_sized(docs), "sizes")
    sources = materialize(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources")
    numbers = sources.withColumnRenamed("source", "s")
    rows = streams(sized).join(numbers, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return materialize(rows, "streams"), sources


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken per row of ``docs`` (doc_id, text, source), and first_shard,
    the first output shard that takes words of it (null if none does).

    Null and empty texts have no words and are taken 0 times; a null source is a source, the last one;
    repeated rows are rows of their own; a null doc_id is kept. Reruns agree: everything follows from
    the rows' contents. Other columns are ignored.
    """
    rows, sources = _plan(docs)
    times = slots(sources).groupBy("source_no", "block").agg(F.count("*").alias("times"), F.min("shard").alias("shard"))
    # Spark takes slots for as small as the sources they unfold from, and would broadcast them.
    met = pieces(rows).join(times.hint("merge"), ["source_no", "block"])
    taken = met.groupBy("source_no", "first_word").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"), F.min("shard").alias("first_shard")
    )
    # Rows with words start at different places of their stream; those without are taken 0 times.
    taken = taken.withColumn("has", F.lit(True))
    out = rows.withColumn("has", F.col("size") > 0).join(taken.hint("merge"), ["source_no", "first_word", "has"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "first_shard")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: for each pass, every row cut down to its words in blocks of that pass.

    Columns are those of ``docs`` (doc_id, text, source and n_chars; others pass through, whatever their
    names). Rows that differ elsewhere only meet their words in the order of those columns. Words keep
    the white space before them. A row comes at most PASSES times; one that no block reaches, or without
    words, does not come.
    """
    rows, sources = _plan(docs)
    met = pieces(rows).join(slots(sources).select("source_no", "block", "pass").hint("merge"), ["source_no", "block"])
    spans = met.groupBy("source_no", "first_word", "pass").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "words"))).alias("spans"),
        F.first("doc_id").alias("d"), F.first("source").alias("s"), F.first("text_key").alias("k"),
    )
    # Equal rows have equal keys, so each is numbered to meet its own spans once.
    twin = Window.partitionBy("d", "s", "k").orderBy("first_word")
    spans = spans.select("d", "s", "k", "spans", F.dense_rank().over(twin).alias("twin"))
    # Columns by number, so that no name of theirs meets one of ours.
    at = {name: f"c{k}" for k, name in enumerate(docs.columns)}
    others = [c for name, c in at.items() if name not in ("doc_id", "source", "text")]
    texts = docs.toDF(*at.values()).select(
        *at.values(), F.col(at["doc_id"]).cast("bigint").alias("id"), F.col(at["source"]).cast("string").alias("of"),
        F.xxhash64(at["text"]).alias("key"),
    )
    rest = F.to_json(F.struct(*others)) if others else F.lit("")
    texts = texts.withColumn("copy", F.row_number().over(Window.partitionBy("id", "of", "key").orderBy(rest)))
    same = (
        F.col("id").eqNullSafe(F.col("d")) & F.col("of").eqNullSafe(F.col("s"))
        & (F.col("key") == F.col("k")) & (F.col("copy") == F.col("twin"))
    )
    every = F.regexp_extract_all(at["text"], F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1))

    def picked(words: Column) -> Column:
        part = lambda s: F.array_join(F.slice(words, (s["from_word"] + 1).cast("int"), s["words"].cast("int")), "")
        return F.array_join(F.transform("spans", part), "")

    # Bound as a variable, the words of a text are split once, not once a span.
    cut = texts.join(spans.hint("merge"), same).withColumn(at["text"], F.transform(F.array(every), picked)[0])
    if "n_chars" in at:
        cut = cut.withColumn(at["n_chars"], F.char_length(at["text"]).cast(docs.schema["n_chars"].dataType))
    return cut.select(*at.values()).toDF(*docs.columns)
