"""Every operator against a brute-force version on small fixtures, odd rows included."""

import hashlib
import re
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from orderlens.llm import (
    chat, embedding_dedup, hashing, licenses, line_dedup, minhash, mixing, packing, quality, queries, topk, toxicity,
)
from orderlens.llm.common import components

WORDS = [f"w{k}" for k in range(400)]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def roots(nodes, links):
    """Smallest member of each node's component."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for start in sorted(nodes):
        todo = [start] if start not in out else []
        while todo:
            at = todo.pop()
            if at not in out:
                out[at] = start
                todo += near[at]
    return out


def edited(rng, words, changes):
    words = list(words)
    for k in rng.choice(len(words), changes, replace=False):
        words[k] = str(rng.choice(WORDS)) + "x"
    return words


@pytest.fixture(scope="module")
def texts():
    """A group of edited copies with a hot base, pairs near the threshold, exact copies, odd texts."""
    rng = np.random.default_rng(3)
    base = list(rng.choice(WORDS, 80))
    rows = [" ".join(base)] * 5
    rows += [" ".join(edited(rng, base, int(n))) for n in rng.integers(1, 6, 60)]
    for _ in range(12):
        one = list(rng.choice(WORDS, 60))
        rows += [" ".join(one), "  ".join(edited(rng, one, int(rng.integers(0, 4)))).upper().replace("W", "w")]
    return rows + ["", None, " \n\t", "one two", "One  TWO", "a b c d", "long " + "word " * 30_000, "ünï cödé text of five words"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "en", f"s{k % 4}" if k % 9 else None, len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_components_of_chains_stars_and_cycles(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    classes = defaultdict(set)
    for row in got:
        classes[row["root"]].add(row["id"])
    assert sorted(map(sorted, classes.values())) == [list(range(41)), list(range(100, 140)), [200, 201, 202]]
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_words_and_shingles_are_those_of_the_pattern(texts):
    for cut in (1 << 20, 64):
        hashing.RUN_BYTES, old = cut, hashing.RUN_BYTES
        sets = list(hashing.shingle_sets(pa.array(texts)))
        hashing.RUN_BYTES = old
        for text, found in zip(texts, sets):
            words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in words_of(text)]
            expected = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
            assert len(found) == len(expected)


def test_near_duplicates_equal_all_pairs(spark, docs, texts):
    sets = {}
    for k, text in enumerate(texts):
        words = [w.lower() for w in words_of(text)]
        sets[k] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    expected = roots(sets, links)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    assert {k: r["component_id"] for k, r in got.items()} == expected
    assert all(r["n_shingles"] == len(sets[k]) and r["kept"] == (expected[k] == k) for k, r in got.items())


def test_near_duplicates_of_odd_tables(spark, docs, none):
    assert minhash.near_duplicates(none).count() == 0
    odd = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "x y z"), (0, "x y z"), (5, None)], "doc_id bigint, text string")
    got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in minhash.near_duplicates(odd.withColumn("set", F.lit(1))).collect()}
    assert got == {(None, 1): (None, True), (1, 1): (0, False), (0, 1): (0, True), (5, 0): (5, True)}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_banded_distance_equals_the_full_table():
    rng = np.random.default_rng(1)
    pairs = []
    for _ in range(300):
        a = list(rng.choice(list("abü𝄞"), int(rng.integers(0, 12))))
        b = list(a)
        for _ in range(int(rng.integers(0, 4))):
            at = int(rng.integers(0, len(b) + 1))
            b[at : at + int(rng.integers(0, 2))] = list(rng.choice(list("abü"), int(rng.integers(0, 2))))
        pairs.append(("".join(a), "".join(b)))
    for most in (1, 2, 3):
        near = line_dedup.within([a for a, _ in pairs], [b for _, b in pairs], most)
        assert near.tolist() == [levenshtein(a, b) <= most for a, b in pairs]
    assert line_dedup.within([], [], 1).tolist() == []


@pytest.mark.parametrize("bucket", [32, 2])
def test_line_classes_equal_all_pairs(spark, bucket, monkeypatch):
    monkeypatch.setattr(line_dedup, "BUCKET", bucket)
    rng = np.random.default_rng(5)
    base = "the quick brown fox jumps over it"
    lines = [base, base + "!", base[1:], base.replace("quick", "quicK"), "short", "short", "", "another line that is alone here"]
    for _ in range(40):
        at = int(rng.integers(0, len(base)))
        lines.append(base[:at] + str(rng.choice(list("XYZ"))) + base[at + int(rng.integers(0, 2)) :])
    rows = [(k // 4, "\n".join(lines[k : k + 4])) for k in range(0, len(lines), 4)] + [(99, None), (None, base), (98, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("line", F.lit("x"))
    places = {(d, i): t for d, text in rows if text and d is not None for i, t in enumerate(text.split("\n")) if len(t) >= 20}
    links = [(a, b) for a, b in combinations(places, 2) if levenshtein(places[a], places[b]) <= 1]
    expected = roots(places, links)
    got = line_dedup.line_classes(docs).collect()
    assert {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"]) for r in got} == expected
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["class_doc_id"], r["class_line_no"])) for r in got)

    left = {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(docs).collect()}
    for doc, text in rows:
        if text is None or doc is None:
            assert left[doc] == text
            continue
        kept = [t for i, t in enumerate(text.split("\n")) if expected.get((doc, i), (doc, i)) == (doc, i)]
        assert left.get(doc) == ("\n".join(kept) if "".join(kept).strip() or not text else None)


@pytest.mark.parametrize("bucket, most", [(32, 3), (2, 3), (2, 2), (1, 5)])
def test_line_classes_of_several_edits_equal_all_pairs(spark, bucket, most, monkeypatch):
    monkeypatch.setattr(line_dedup, "BUCKET", bucket)
    rng = np.random.default_rng(11)
    texts = ["Released on 2024-01-15 by the group of nine", "Released on 2023-12-31 by the group of nine"]
    for size in (20, 22, 29, 30, 33, 39, 40, 41, 47, 60, 75):
        base = "".join(rng.choice(list("abcdeü𝄞 "), size - 1)) + "."
        texts.append(base)
        for _ in range(14):
            line, start = list(texts[-1] if rng.random() < 0.4 else base), texts[-1][: size // 2]
            for _ in range(int(rng.integers(1, most + 2))):
                at = int(rng.integers(0, len(line)))
                line[at : at + int(rng.integers(0, 2))] = list(rng.choice(list("XYZ"), int(rng.integers(0, 2))))
            texts.append("".join(line) if rng.random() < 0.8 else start + "".join(rng.choice(list("abc "), size - len(start) - 1)) + ".")
    rows = [(k // 3, "\n".join(texts[k : k + 3])) for k in range(0, len(texts), 3)]
    places = {(d, i): t for d, text in rows for i, t in enumerate(text.split("\n")) if len(t) >= 20}
    allowed = lambda a, b: min(most, min(len(a), len(b)) // 10 - 1)
    near = lambda a, b: abs(len(a) - len(b)) <= most and levenshtein(a, b) <= allowed(a, b)
    expected = roots(places, [(a, b) for a, b in combinations(places, 2) if near(places[a], places[b])])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = line_dedup.line_classes(docs, most).collect()
    assert {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"]) for r in got} == expected


@pytest.mark.parametrize("most", [1, 2, 3, 5, 12])
def test_lines_within_the_limit_meet_by_few_keys(most):
    """A line within the limit probes with a key of the other one, at any lengths; a line has a third of the keys that
    every length and shift would take (26 of a line of limit 3, and less than 11 on average now)."""
    rng, met, keys = np.random.default_rng(21), 0, []
    for size in (20, 21, 29, 30, 31, 39, 40, 42, 49, 50, 52, 59, 79, 80, 130, 160, 162, 319, 321) * 4:
        one = "".join(rng.choice(list("abcdefghijklmnopü𝄞"), size))
        other, edits = list(one), int(line_dedup.limit(np.array([size]), most)[0])
        for edit in rng.integers(0, 3, edits):
            at = int(rng.integers(0, len(other)))
            other[at : at + int(edit > 0)] = ["X"] * int(edit < 2)
        pair = [one, "".join(other)]
        shorter = min(map(len, pair))
        if shorter < 20 or pair[0] == pair[1] or levenshtein(*pair) > line_dedup.limit(np.array([shorter]), most)[0]:
            continue
        batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array(pair)], ["h", "text"])
        rows = [tuple(r.values()) for out in line_dedup._keys(iter([batch]), most) for r in out.to_pylist()]
        every, index = ([{key for key, h, probes in rows if h == n and not (own and probes)} for n in (0, 1)] for own in (False, True))
        assert index[0] & every[1] or index[1] & every[0], pair
        met, keys = met + 1, keys + [len(rows) / 2]
    assert met > 40 and (most != 3 or np.mean(keys) < 11)


def test_line_dedup_links_changed_numbers_by_default(spark):
    docs = spark.createDataFrame([(1, "Page 117 of the minutes, printed for the members"), (2, "Page 204 of the minutes, printed for the members")], "doc_id bigint, text string")
    assert [r["doc_id"] for r in line_dedup.line_classes(docs).where("kept").collect()] == [1]


def test_line_dedup_query_takes_short_lines_but_links_them_only_if_equal(spark, tmp_path):
    rows = [(1, "Les.\n\nOf it."), (2, "Of it.\nLes.\nLess."), (3, " \t\nLes."), (4, "Les.\nown")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.queries()["op2_line_dedup"](spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["line_no"]): (r["class_doc_id"], r["class_line_no"]) for r in got} == {
        (1, 0): (1, 0), (1, 2): (1, 2), (2, 0): (1, 2), (2, 1): (1, 0), (2, 2): (2, 2), (3, 1): (1, 0), (4, 0): (1, 0), (4, 1): (4, 1),
    }
    left = corpus_pipeline.line_stage(spark, docs, "")
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {1: "Les.\n\nOf it.", 2: "Less.", 4: "own"}


def test_line_dedup_of_an_empty_table_and_clashing_columns(spark, none):
    assert line_dedup.line_classes(none).count() == 0
    assert line_dedup.deduplicated(none).columns == none.columns
    clash = spark.createDataFrame([(1, "same text, twenty chars long\nmine", "x", 9), (2, "same text, twenty chars long", "y", 9)], "doc_id bigint, text string, gone string, n_chars bigint")
    assert [tuple(r) for r in line_dedup.deduplicated(clash).collect()] == [(1, "same text, twenty chars long\nmine", "x", 33)]


def water(sizes, weights):
    total, targets, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        level = (total - sum(targets[k] for k in range(len(sizes)) if k not in open_)) / sum(weights[k] for k in open_)
        over = {k for k in open_ if level * weights[k] > 3 * sizes[k] + 1e-9}
        if not over:
            for k in open_:
                targets[k] = level * weights[k]
            break
        for k in over:
            targets[k] = 3.0 * sizes[k]
        open_ -= over
    return targets


def test_mix_meets_targets_and_reruns_agree(docs, texts):
    rows = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    again = {r["doc_id"]: r for r in mixing.mix(docs.repartition(5)).collect()}
    assert rows == again
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes = defaultdict(int)
    for k, text in enumerate(texts):
        assert rows[k]["size"] == len(words_of(text))
        sizes[source[k]] += rows[k]["size"]
    names = sorted((s for s in sizes if s is not None)) + [None]
    expected = dict(zip(names, water([sizes[s] for s in names], [k % 3 + 1 for k in range(len(names))])))
    for k, row in rows.items():
        assert row["source_size"] == sizes[source[k]] and row["target"] == pytest.approx(expected[source[k]])
        assert 0 <= row["taken"] <= 3 * row["size"]
    for s in names:
        assert abs(sum(rows[k]["taken"] for k in rows if source[k] == s) - expected[s]) <= 2 * mixing.BLOCK


def test_mixed_documents_hold_what_the_mix_takes(spark, docs, none):
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    found = defaultdict(int)
    for row in mixed.collect():
        found[row["doc_id"]] += len(words_of(row["text"]))
        assert row["n_chars"] == len(row["text"])
    assert {k: n for k, n in taken.items() if n} == dict(found)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_shards_draw_multinomial_counts(spark, monkeypatch):
    """Counts of a source sum to its total, cover its slots without gaps and spread evenly over the shards."""
    monkeypatch.setattr(mixing, "SHARD", 500)
    sizes = spark.createDataFrame([("a", 400_000), ("b", 900_000), ("c", 100), (None, 0)], "source string, source_size bigint")
    sources = mixing.targets(sizes).cache()
    counts = defaultdict(list)
    for r in mixing.shard_counts(sources).orderBy("source_no", "shard").collect():
        counts[r["source_no"]].append((r["shard"], r["first"], r["until"]))
    totals = {r["source_no"]: round(r["target"] * -(-r["source_size"] // mixing.BLOCK) / r["source_size"]) for r in sources.where("source_size > 0").collect()}
    shards = -(-sum(totals.values()) // 500)
    for source, total in totals.items():
        ends = [0, *(until for _, _, until in counts[source])]
        assert ends[-1] == total and [first for _, first, _ in counts[source]] == ends[:-1]
        drawn = {shard: until - first for shard, first, until in counts[source]}
        square = sum((drawn.get(k, 0) - total / shards) ** 2 / (total / shards) for k in range(shards))
        assert set(drawn) <= set(range(shards)) and square < shards + 5 * (2 * shards) ** 0.5
    slots = mixing.slots(sources).collect()
    got = defaultdict(list)
    for r in slots:
        got[r["source_no"], r["shard"]].append(r["slot"])
    assert {key: (min(v), max(v) + 1, len(v)) for key, v in got.items()} == {
        (s, shard): (first, until, until - first) for s, rows in counts.items() for shard, first, until in rows
    }


def test_mixed_documents_pass_on_columns_of_any_name(spark, docs):
    names = ["d", "S", "k", "spans", "twin", "_k", "_twin", "id", "of", "key", "copy", "c0", "slot", "shard", "pass", "block", "part"]
    extra = docs.select("*", *[F.concat(F.lit(n), F.lit(" "), "doc_id").alias(n) for n in names], F.create_map(F.lit(1), "doc_id").alias("set"))
    mixed = mixing.mixed_documents(extra)
    assert mixed.columns == extra.columns
    rows = mixed.collect()
    assert all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in names) and all(r["set"] == {1: r["doc_id"]} for r in rows)
    key = lambda r: (r["doc_id"], r["text"], r["n_chars"])
    assert sorted(map(key, rows)) == sorted(map(key, mixing.mixed_documents(docs).collect()))


def test_mix_takes_no_python(docs, capsys):
    mixing.mix(docs).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(3)).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))


@pytest.mark.parametrize("possible", [4, 0])
def test_top_k_equals_all_scores(spark, possible, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 2)
    monkeypatch.setattr(topk, "POSSIBLE", possible)
    rng = np.random.default_rng(2)
    vectors = {k: rng.integers(-60, 60, 8).tolist() for k in range(150)}
    vectors |= {150: vectors[0], 151: vectors[0], 200: [0] * 8, 250: [1, 2], 300: [3, 4]}
    odd = [(None, [1] * 8), (400, None), (450, [1, None]), (500, [])]
    rows = spark.createDataFrame([*vectors.items(), *odd], "vec_id bigint, vector array<bigint>").withColumn("id", F.lit(0))
    got = defaultdict(list)
    for r in topk.top_k(rows, rows.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    for q in (k for k in vectors if k % 50 == 0):
        scored = sorted((-int(np.dot(vectors[q], v)), k) for k, v in vectors.items() if k != q and len(v) == len(vectors[q]))[:5]
        assert got.pop(q) == [(i + 1, k, -s) for i, (s, k) in enumerate(scored)]
    assert not got
    empty = rows.limit(0)
    assert topk.top_k(empty, empty).count() == 0


def test_top_k_reads_and_rescores_few_where_rows_have_structure():
    """Rows around centres: most postings stay unread, and no more than a few times k rows are rescored."""
    rng = np.random.default_rng(8)
    centres = rng.laplace(size=(300, 64)) ** 3
    vectors = centres[rng.integers(0, 300, 6000)] + 0.05 * rng.normal(size=(6000, 64))
    vectors = np.floor(256 * vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.int64)
    ids = rng.permutation(6000)
    index = topk.Index(ids, vectors)
    for q in range(20):
        found, scores = index.best(vectors[q], ids[q], 5)
        every = vectors @ vectors[q]
        expected = sorted((-every[r], ids[r]) for r in range(6000) if r != q)[:5]
        assert list(zip(-scores, found)) == expected
    assert index.rescored < 20 * 60 and index.read < 0.7 * 20 * vectors.size


def test_top_k_of_zero_negative_and_huge_weights():
    vectors = np.array([[1, -2, 0], [3, 0, 0], [-5, 4, 0], [3, 0, 7]])
    index = topk.Index(np.array([4, 3, 2, 1]), vectors)
    for query in ([0, 0, 0], [-1, 2, 0], [0, -3, 5], [1, 0, 0]):
        found, scores = index.best(np.array(query), 9, 5)
        assert list(zip(found, scores)) == sorted(zip([4, 3, 2, 1], vectors @ query), key=lambda x: (-x[1], x[0]))
    with pytest.raises(ValueError, match="fit a long"):
        index.best(np.array([2**60, 0, 0]), 9, 5)


@pytest.mark.parametrize("dim", [2, 64, 100])
def test_tiles_stop_early_and_lose_no_link(dim):
    """Links and components are those of all pairs, for a fraction of the multiplications, also of a tile with itself."""
    rng = np.random.default_rng(dim)
    spread = 0.95 ** np.arange(dim) if dim > 2 else np.ones(dim)
    centres = rng.normal(size=(150, dim)) * spread
    rows = np.concatenate([centres + 0.08 * spread * rng.normal(size=centres.shape) for _ in range(8)])
    vectors = embedding_dedup.unit(rows)
    copies = rng.integers(1, 4, len(vectors))
    turn = embedding_dedup.axes(vectors)
    near = vectors @ vectors.T >= embedding_dedup.THRESHOLD
    np.fill_diagonal(near, False)
    counts, label, spent = embedding_dedup.compare(vectors, None, copies, None, turn)
    assert counts.tolist() == (near @ copies).tolist()
    expected = roots(range(len(vectors)), list(zip(*np.nonzero(near))))
    assert label.tolist() == [expected[k] for k in range(len(vectors))]
    half = len(vectors) // 3
    counts, _, across = embedding_dedup.compare(vectors[:half], vectors[half:], copies[:half], copies[half:], turn)
    cut = near.copy()
    cut[:half, :half] = cut[half:, half:] = False
    assert counts.tolist() == (cut @ copies).tolist()
    if dim > 2:
        assert spent < 0.25 * near.size * dim and across < 0.5 * half * (len(vectors) - half) * dim


@pytest.mark.parametrize("partners", [2, 8])
def test_embedding_links_equal_all_pairs(spark, monkeypatch, partners):
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    monkeypatch.setattr(embedding_dedup, "PARTNERS", partners)
    rng = np.random.default_rng(4)
    hub = rng.normal(size=24)
    rows = [(k, (hub + 0.12 * rng.normal(size=24)).tolist()) for k in range(60)]
    rows += [(k, rng.normal(size=24).tolist()) for k in range(60, 100)]
    rows += [(100, rows[99][1]), (101, rows[99][1]), (102, [1.0, 0.0]), (103, [2.0, 0.0]), (104, [1e-300, 0.0])]
    odd = [(105, None), (106, [0.0] * 24), (107, [float("nan")] * 24), (108, [None, 1.0]), (109, []), (None, [1.0, 0.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumn("id", F.lit(1))
    cosine = lambda x, y: len(x) == len(y) and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95
    unit = {k: np.array(v) / np.abs(v).max() for k, v in rows}
    links = [(a, b) for a, b in combinations(unit, 2) if cosine(unit[a], unit[b])]
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    expected = roots([*unit, 105, 106, 107, 108, 109], links)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(frame).collect()}
    last = got.pop(None)
    assert (last["n_links"], last["component_id"], last["kept"]) == (0, None, True)
    assert {k: (r["n_links"], r["component_id"]) for k, r in got.items()} == {k: (count[k], c) for k, c in expected.items()}
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


CONVERSATIONS = [
    (1, 0, "system", "be <|im_end|> kind"), (1, 1, "user", "hi <\\\\| there"), (1, 2, "assistant", "hello " * 300),
    (1, 3, "user", "x " * 900), (1, 4, "assistant", "<|im_start|>assistant\nno"), (1, 5, "assistant", "y " * 3000), (1, 6, "user", "b " * 600),
    (1, 7, "assistant", "fine"), (1, 8, "user", "z " * 500),
    (2, 0, "user", None), (2, 1, "assistant", ""), (2, 1, "assistant", ""), (3, None, "as\\n\nx", "tail <|"), (None, 0, "assistant", "lost"),
]


def test_chat_round_trip_and_windows(spark):
    frame = spark.createDataFrame(CONVERSATIONS, "conv_id bigint, turn bigint, role string, text string").withColumn("window", F.lit(7))
    turns = defaultdict(list)
    for conv, turn, role, text in sorted(CONVERSATIONS, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1], r[2], r[3] or "")):
        turns[conv].append((role, text or ""))
    got = {r["conv_id"]: r for r in queries.chat_digest(frame).collect()}
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        whole = "".join(f"{role}\n{text}\n" for role, text in rows)
        loss = "".join(text for role, text in rows if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(rows), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    windows = [r for r in chat.windows(frame).collect() if r["conv_id"] == 1]
    assert len(windows) > 2 and sum(r["formatted_chars"] for r in got.values()) > sum(len(r["text"]) for r in windows)
    for r in windows:
        assert next(chat.turns_of(r["text"])) == ("system", "be <|im_end|> kind")
        assert r["over_budget"] == (r["n_tokens"] > chat.BUDGET)
        assert not r["over_budget"] or r["n_turns"] == 1
    assert any(r["n_repeated"] > 1 for r in windows)
    assert queries.chat_digest(frame.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\|im_end|>", "a<|b<\\|c", "<<||"])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text + "\\n\n\\")) == text + "\\n\n\\"


def test_packing_puts_every_id_into_one_piece(spark, docs, texts, none):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    spaced = "a  b \n c\t\td e\u00a0 f don't  "
    end = "<|endoftext|>"
    marked = {901: end, 902: f"a{end}b", 903: f"x {end}{end} y  {end}\n", 904: "<|endoftext|", 905: f"two words{end} three"}
    more = [(900, spaced), (None, spaced), *marked.items()]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id bigint, text string"))
    by_id = {**dict(enumerate(texts)), 900: spaced, None: spaced, **marked}
    pieces = packing.pack(rows).collect()
    whole, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        whole[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
        assert p["ids_crc32"] == zlib.crc32(p["ids"]) and len(p["ids"]) == 4 * p["length"] and p["length"] > 0
    for doc, text in by_id.items():
        own = sorted(whole[doc], key=lambda p: p["start"])
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert np.frombuffer(b"".join(p["ids"] for p in own), "<u4").tolist() == ids
        assert [p["start"] for p in own] == np.cumsum([0, *(p["length"] for p in own)])[:-1].tolist()
        assert {p["doc_tokens"] for p in own} == {len(ids)}
    used = padded = 0
    for own in sequences.values():
        own = sorted(own, key=lambda p: p["offset"])
        filled = sum(p["length"] for p in own)
        assert [p["offset"] for p in own] == np.cumsum([0, *(p["length"] for p in own)])[:-1].tolist()
        assert filled <= 1024
        used += filled
        padded += filled if filled & (filled - 1) == 0 else 1024
    assert padded <= 1.01 * used
    assert packing.pack(none).count() == 0


def test_licenses_equal_all_windows(spark, none):
    notice = licenses.TEMPLATES["MIT-text"]
    filler = " ".join(WORDS[:90])
    near = notice.replace("charge", "cost").replace("merge", "join")
    rows = [
        (1, f"{filler} {notice} {filler}"), (2, f"{filler}\n{near}\n{filler}"), (3, " ".join(notice.split()[: len(notice.split()) // 2])),
        (4, filler + " Released under the mit LICENSE. " + filler), (5, filler), (6, None), (7, ""), (8, "tiny"), (9, (filler + " ") * 200 + notice),
        (10, filler + "\n" + licenses.TEMPLATES["GPL-3.0"]), (None, licenses.TEMPLATES["CC-BY-NC-4.0"]),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("license", F.lit("x"))
    templates = {**licenses.TEMPLATES, "tiny": "TINY", "none": " "}
    sets = {n: {tuple(t.lower().split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for n, t in templates.items() if t.split()}
    expected = {}
    for doc, text in rows:
        words = (text or "").lower().split()
        shingles = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        for name, template in sets.items():
            if len(shingles & template) / len(template) >= 0.75:
                expected[doc, name] = len(shingles & template) / len(template)
    got = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.scan(frame, templates).collect()}
    assert got == pytest.approx(expected)
    assert licenses.scan(none).count() == 0


def test_licenses_are_found_in_comments_and_without_marks(spark):
    own = licenses.TEMPLATES

    def wrapped(text, sign, width=8):
        words = text.split()
        return "\n".join(sign + " ".join(words[k : k + width]) for k in range(0, len(words), width))

    asf = own["Apache-2.0-header"].replace("Licensed under", "The ASF licenses this file to You under")
    rows = [
        (1, "/*\n" + wrapped(own["Apache-2.0-header"], " * ") + "\n */"), (2, wrapped(asf, "# ")), (3, wrapped(own["GPL-3.0-header"], " * ")),
        (4, "code; // Released under the MIT License"), (5, "<!--Licensed under CC BY-NC 4.0-->"), (6, "\u201cLicensed under CC BY-SA 4.0\u201d, it says"),
        (7, "Licensed under the Apache License, Version 1.1."), (8, "Licensed under CC BY-NC 3.0."), (9, "* // --"), (10, "so be it: a-b c, as ever"),
        (11, own["BSD-3-Clause"].replace("forms,", "forms")),
    ]
    found = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), {**own, "four": "(a-b c as ever)", "signs": "* //"}).collect():
        found.setdefault(r["doc_id"], set()).add(r["license"])
    assert found == {
        1: {"Apache-2.0", "Apache-2.0-header"}, 2: {"Apache-2.0", "Apache-2.0-header"}, 3: {"GPL-3.0-header"}, 4: {"MIT"},
        5: {"CC-BY-NC-4.0"}, 6: {"CC-BY-SA-4.0"}, 10: {"four"}, 11: {"BSD-3-Clause"},
    }


def test_band_settings_keep_the_promise():
    for block, sizes in ((1, [1]), (4, [3, 4]), (64, [33, 64])):
        many = licenses.bands(sizes, block)
        for m in sizes:
            need = licenses._need(m)
            assert (1 - need / (2 * block + m - need)) ** many <= 1.01 * licenses.MISS


def _graded(spark, n=240):
    rng = np.random.default_rng(8)
    rows, marks = [], []
    for k in range(n):
        grade = k % 3
        junk = ["BUY!!", "$$$", "NOW!!"]
        share = (0.6, 0.25, 0.0)[grade]
        words = [str(rng.choice(junk)) if rng.random() < share else str(rng.choice(WORDS)) for _ in range(60)]
        rows.append((k, " ".join(words), "en", "s", 0))
        marks.append((k, grade))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id bigint, quality int")


def test_quality_orders_three_grades_of_unseen_documents(spark, none):
    docs, ratings = _graded(spark)
    model = quality.fit(docs, ratings.where("doc_id < 150"))
    assert list(model.grades) == [0, 1, 2] and (np.diff(model.thresholds) > 0).all()
    rows = quality.score(docs, model, good=2).join(ratings, "doc_id").where("doc_id >= 150").collect()
    mean = [np.mean([r["expected_grade"] for r in rows if r["quality"] == g]) for g in range(3)]
    assert mean[0] + 0.5 < mean[1] and mean[1] + 0.5 < mean[2]
    assert np.mean([r["selected"] == (r["quality"] == 2) for r in rows]) > 0.9
    assert quality.score(none, model).columns[-3:] == ["expected_grade", "good_probability", "selected"]


def test_quality_slopes_are_those_of_the_likelihood(monkeypatch):
    """Against finite differences of the cumulative-link loss, written out densely, for four grades."""
    rng, size, cuts, kept = np.random.default_rng(8), 12, 3, []
    monkeypatch.setattr(quality, "BUCKETS", size)
    monkeypatch.setattr(quality, "descend", lambda start, slope, steps, rate: kept.append(slope) or start)
    dense = rng.normal(size=(40, size)) * (rng.random((40, size)) < 0.4)
    labels = np.arange(40) % 4
    at = [np.flatnonzero(row) for row in dense]
    quality.fit_rows(at, [row[k] for row, k in zip(dense, at)], labels)

    def loss(x):
        steps = np.concatenate([[x[size]], np.exp(x[size + 1:])])
        edges = np.concatenate([[-np.inf], np.cumsum(steps), [np.inf]])
        below = lambda edge, score: 1 / (1 + np.exp(-(edge - score)))
        score = dense @ x[:size]
        chance = below(edges[labels + 1], score) - below(edges[labels], score)
        return -np.log(chance).mean() + quality.DECAY / 2 * (x[:size] ** 2).sum()

    for _ in range(3):
        x = rng.normal(size=size + cuts) * 0.5
        small = 1e-6 * np.eye(size + cuts)
        expected = [(loss(x + d) - loss(x - d)) / 2e-6 for d in small]
        assert np.allclose(kept[0](x), expected, atol=1e-5)


def test_quality_of_odd_rows_and_without_ratings(spark, none):
    docs, ratings = _graded(spark, 60)
    model = quality.fit(docs, ratings.unionByName(spark.createDataFrame([(None, 1), (3, None)], ratings.schema)))
    odd = spark.createDataFrame([(1, None, 5), (None, "", 6), (2, " \n", 7), (3, "w1 w2 w3", 8)], "doc_id bigint, text string, selected int")
    rows = quality.score(odd, model).toArrow()
    assert rows.num_rows == 4 and rows.column_names.count("selected") == 2
    flags = dict(zip(rows.column(2).to_pylist(), rows.column(5).to_pylist()))
    assert not (flags[5] or flags[6] or flags[7])
    unrated = quality.score(docs, quality.fit(docs, ratings.limit(0)))
    assert unrated.where("selected").count() == 0
    assert quality.fit(none, ratings).weights.any() == False  # noqa: E712


def _insults(spark, n=400):
    rng = np.random.default_rng(9)
    rows, marks = [], []
    for k in range(n):
        words, toxic = [f"v{w}" for w in rng.integers(0, 9000, 100)], k % 2
        if toxic:
            words[int(rng.integers(100))] = str(rng.choice(["idiot", "idiots,", "Moron", "moronic"]))
            if rng.random() < 0.9:
                words[int(rng.integers(100))] = "muslims"
        rows.append((k, " ".join(words), "en", "s", 0))
        marks.append((k, toxic))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, "doc_id bigint, toxic int")


def test_toxicity_holds_on_unseen_documents_and_spares_group_names(spark):
    docs, labels = _insults(spark)
    fitted = toxicity.fit(docs, labels.where("doc_id < 300"))
    rows = toxicity.score(docs, fitted).join(labels, "doc_id").where("doc_id >= 300").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    plain = toxicity.fit(docs, labels.where("doc_id < 300"), identities=())
    named, swapped = pa.array(["they met muslims there"]), pa.array(["they met christians there"])
    gap = lambda m: abs(np.log(m.scores(named) / (1 - m.scores(named))) - np.log(m.scores(swapped) / (1 - m.scores(swapped))))[0]
    assert gap(fitted) < 0.5 * gap(plain)
    assert fitted.scores(named)[0] < 0.7


def test_toxicity_learns_from_late_passages_of_long_documents(spark):
    """Every passage of a labelled document is fitted on: the marked word stands in its last one only."""
    rng = np.random.default_rng(12)
    rows = [(k, " ".join([*rng.choice(WORDS, 4000), "vile" if k % 2 else "mild"]), k % 2) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    bad, good = model.scores(pa.array(["so vile", "so mild"]))
    assert bad > 0.7 > good
    size = len(rows[0][1])
    few = toxicity._sampled(docs, docs.select("doc_id", "toxic"), "toxic", 60, 20 * size).collect()
    assert 0 < len(few) < 60 and {r["text"] for r in few} <= {t for _, t, _ in rows}
    assert toxicity._sampled(docs, docs.select("doc_id", "toxic"), "toxic", 60, 10 * size).count() == 0


def test_toxicity_slopes_are_those_of_the_penalised_likelihood(monkeypatch):
    """Against finite differences of the loss, written out densely: the counterfactual gap is squared and averaged."""
    rng, size, kept = np.random.default_rng(9), 10, []
    monkeypatch.setattr(toxicity, "BUCKETS", size)
    monkeypatch.setattr(toxicity, "MIN_DOCS", 1)
    monkeypatch.setattr(toxicity, "descend", lambda start, slope, steps, rate: kept.append(slope) or start)
    features = [rng.integers(0, size, 4) for _ in range(30)] + [np.arange(size)]
    swapped = [np.where(f == f[0], (f[0] + 1) % size, f) if k % 3 == 0 else None for k, f in enumerate(features)]
    labels = (np.arange(31) % 4 == 0).astype(np.int64)
    toxicity.fit_passages(np.arange(31), labels, features, swapped)
    counts = lambda rows: np.array([np.bincount(f, minlength=size) for f in rows])
    dense, twins = counts(features), [k for k, f in enumerate(swapped) if f is not None]
    other = counts([swapped[k] for k in twins])
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())

    def loss(x):
        p = 1 / (1 + np.exp(-(dense @ x[:-1] + x[-1])))
        fit = -(share * np.where(labels == 1, np.log(p), np.log(1 - p))).sum()
        gap = dense[twins] @ x[:-1] - other @ x[:-1]
        return fit + toxicity.PENALTY * (gap**2).mean() + toxicity.DECAY / 2 * (x[:-1] ** 2).sum()

    for _ in range(3):
        x = rng.normal(size=size + 1) * 0.5
        expected = [(loss(x + d) - loss(x - d)) / 2e-6 for d in 1e-6 * np.eye(size + 1)]
        assert np.allclose(kept[0](x), expected, atol=1e-5)


def test_toxicity_of_odd_rows(spark, none):
    docs, labels = _insults(spark, 60)
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(1, None), (None, ""), (2, " . "), (2, "idiot " * 5000), (3, "moron")], "doc_id bigint, text string").withColumn("score", F.lit(2))
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert toxicity.score(none, model).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).where("predicted = 1").count() == 0


def crowd(rng, n):
    """Lines that share a long beginning: most far apart, some within the limit of another, some of few grams."""
    base = "a passage that very many documents hold word by word and that goes on for a while before it ends: "
    tails = ["".join(rng.choice(list("abcdefghijklmnop "), 40)) for _ in range(n)]
    lines = [base + t for t in tails]
    lines += [base + t[:k % 37] + "#" * (k % 4) + t[k % 37 + k % 3 :] for k, t in enumerate(tails[: n // 5])]
    return lines + ["-" * k for k in range(40, 100, 3)] + ["=" * 50 + "-" * k for k in range(40, 60)]


def test_lines_of_a_crowded_bucket_equal_all_pairs(spark):
    lines = list(dict.fromkeys(crowd(np.random.default_rng(8), 50)))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "doc_id bigint, text string").repartition(3)
    near = [(a, b) for a, b in combinations(range(len(lines)), 2)
            if abs(len(lines[a]) - len(lines[b])) <= 3 and lines[a][0] == lines[b][0]
            and levenshtein(lines[a], lines[b]) <= line_dedup.limit(np.array([min(len(lines[a]), len(lines[b]))]), 3)[0]]
    got = {r["doc_id"]: r["class_doc_id"] for r in line_dedup.line_classes(docs).collect()}
    assert got == roots(range(len(lines)), near)


def test_a_crowd_that_is_far_apart_forms_few_pairs(spark, monkeypatch):
    """A thousand lines of one long beginning: the pairs that are formed grow with the lines, not with their square."""
    lines = [t for t in crowd(np.random.default_rng(9), 1000)[:1000]]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    formed, across = [], line_dedup._across

    def counted(*args):
        pairs = across(*args).cache()
        formed.append(pairs.count())
        return pairs

    monkeypatch.setattr(line_dedup, "_across", counted)
    got = line_dedup.line_classes(docs).collect()
    assert len(got) == 1000 and len(formed) == 1 and formed[0] < 5000


def test_variants_of_a_line_form_few_pairs(spark, monkeypatch):
    """Copies of one line with another word each: lines meet where they differ from it, and not all in pairs."""
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 4)) for _ in range(30)]
    lines = [" ".join(words)]
    for _ in range(250):
        at = int(rng.integers(0, 30))
        lines.append(" ".join([*words[:at], "".join(rng.choice(list("qrstuvwxyz"), 4)), *words[at + 1 :]]))
    lines += [t.replace("q", "Q", 1) for t in lines[1:61] if "q" in t]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    formed, across = [], line_dedup._across

    def counted(*args):
        pairs = across(*args).cache()
        formed.append(pairs.count())
        return pairs

    monkeypatch.setattr(line_dedup, "_across", counted)
    got = {r["doc_id"]: r["class_doc_id"] for r in line_dedup.line_classes(docs).collect()}
    every = list(combinations(range(len(lines)), 2))
    near = line_dedup.within([lines[a] for a, _ in every], [lines[b] for _, b in every], 3)
    assert got == roots(range(len(lines)), [pair for pair, n in zip(every, near) if n])
    assert len(formed) == 1 and formed[0] < 5000


def test_lines_of_a_common_beginning_and_many_lengths_take_no_grams(spark, monkeypatch):
    """Cells hold lines of like lengths only, so that a crowd of many lengths is told apart without grams."""
    rng, base = np.random.default_rng(22), "".join(np.random.default_rng(23).choice(list("abcdefghij"), 300))
    lines = [base + "".join(rng.choice(list("klmnopqrst"), int(size))) for size in rng.integers(640, 700, 400)]
    monkeypatch.setattr(line_dedup, "CROWD", 3)
    monkeypatch.setattr(line_dedup, "_rarest", lambda *args: pytest.fail("lines of unlike lengths are in one cell"))
    docs = spark.createDataFrame([*enumerate(lines), (400, lines[7][:-1])], "doc_id bigint, text string")
    assert [(r["doc_id"], r["class_doc_id"]) for r in line_dedup.line_classes(docs).collect() if not r["kept"]] == [(400, 7)]


def test_spans_of_lines_within_the_limit_overlap():
    """The bound that cells rest on, against the full table: what one line reaches unchanged, the other reaches with the edits between them."""
    rng = np.random.default_rng(13)
    hub = "".join(rng.choice(list("abc"), 40))
    lines = [hub]
    for _ in range(90):
        line = list(lines[int(rng.integers(0, len(lines)))])
        for _ in range(int(rng.integers(1, 5))):
            at = int(rng.integers(0, len(line) + 1))
            line[at : at + int(rng.integers(0, 2))] = list(rng.choice(list("abcd"), int(rng.integers(0, 2))))
        lines.append("".join(line))
    for most in (1, 3):
        spans = [line_dedup.compared([t] * len(lines), texts, most)[1:] for t, texts in ((hub, lines), (hub[::-1], [t[::-1] for t in lines]))]
        near = [(a, b) for a, b in combinations(range(len(lines)), 2) if abs(len(lines[a]) - len(lines[b])) <= most and levenshtein(lines[a], lines[b]) <= most]
        assert near
        for least, reach in spans:
            assert all(least[a] <= reach[b] and least[b] <= reach[a] for a, b in near)


def test_top_k_packs_counts_only_where_impacts_leave_room_for_them():
    """Rows seen are counted in the sums of their impacts; impacts too large for that are added apart, to the same rows."""
    rng = np.random.default_rng(4)
    for largest in (50, 2**22):
        vectors = rng.integers(-largest, largest, (700, 12))
        index, ids = topk.Index(np.arange(700), vectors), np.arange(700)
        for q in range(15):
            found, scores = index.best(vectors[q], q, 5)
            every = vectors @ vectors[q]
            assert list(zip(-scores, found)) == sorted((-every[r], r) for r in ids if r != q)[:5]


def test_top_k_passes_over_tries_that_have_no_hope(monkeypatch):
    """Rows without structure: the proof is not tried after every step, and reads few postings more for that."""
    rng = np.random.default_rng(5)
    vectors = rng.integers(-99, 99, (4000, 32))
    index, tries, partition = topk.Index(np.arange(4000), vectors), [], np.argpartition
    monkeypatch.setattr(np, "argpartition", lambda *args: tries.append(1) or partition(*args))
    for q in range(10):
        index.best(vectors[q], q, 5)
    assert len(tries) <= 10 * 9 and index.read <= 10 * vectors.size
