"""Merkle manifest, conversation repair and byte-pair coding against brute force, odd rows included."""

import hashlib
import random
import re
import zlib
from functools import cache, partial

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import bpe, merkle, ordered, queries, repair

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CHAT = "conv_id bigint, turn bigint, role string, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(tmp_path, df, name):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# -- Merkle manifest ----------------------------------------------------------
def leaf(row, text):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*[part(v) for v in (row[0], row[3], row[2], row[4], text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def proof(tree, k):
    path = []
    for nodes in tree[:-1]:
        first = k - k % 3
        path.append((nodes[first:k], nodes[k + 1 : first + 3]))
        k //= 3
    return path


def fold(path, digest):
    for left, right in path:
        digest = sha(*left, digest, *right)
    return digest


def manifest(rows):
    """The contract of op11, row by row."""
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted((r for r in rows if r[3] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[source] = (own, levels([leaf(r, r[1]) for r in own]))
    over = levels([trees[s][1][-1][0] for s in sources])
    out = []
    for k, source in enumerate(sources):
        own, tree = trees[source]
        for j, row in enumerate(own):
            path = proof(tree, j) + proof(over, k)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None
            folded = fold(path, leaf(row, row[1].replace("\n", "") if hit else row[1]))
            siblings = sha(*[d for left, right in path for d in left + right])
            out.append((row[0], leaf(row, row[1]), tree[-1][0], over[-1][0], siblings, folded, folded == over[-1][0]))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n, sources, block", [(1, 1, 2), (2, 1, 1), (400, 5, 2), (300, 40, 1), (27, 1, 1), (28, 1, 1), (82, 2, 6)])
def test_manifest_equals_brute_force(spark, tmp_path, monkeypatch, n, sources, block):
    monkeypatch.setattr(merkle, "manifest", partial(merkle.manifest, levels=block))
    rng = random.Random(n)
    names = [None, "", "é", "z", "Z"] + [f"s{k}" for k in range(sources)]
    rows = [(k, "line\n" * rng.randrange(4) + "ü", "en", names[min(rng.randrange(2 * sources), sources - 1)], k) for k in range(n)]
    if n > 50:
        rows += [(None, "a\nb", None, "s", None), (None, None, "en", "s", 3), rows[3], rows[3], (7, "other\ntext", "de", rows[7][3], None), (900, None, None, None, None), (901, "", "", "", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"at": F.lit(1), "Held": F.lit("x"), "tree": F.lit(None)}).repartition(5)
    got = queries.queries()["op11_merkle_manifest"](spark, written(tmp_path, docs, "documents"))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=key) == sorted(manifest(rows), key=key)


def test_manifest_of_no_rows(spark, tmp_path):
    assert queries.queries()["op11_merkle_manifest"](spark, written(tmp_path, spark.createDataFrame([], DOCS), "documents")).count() == 0


def test_folding_resumes_the_state_before_the_slot():
    """The retained states give what hashing all children again gives, for every slot and shape."""
    for n in (1, 2, 3, 4, 9, 10, 26, 28):
        leaves = [sha(str(k)) for k in range(n)]
        tree = merkle.MidstateTree(leaves, merkle.depth(n))
        assert tree.top == levels(leaves)[-1][0]
        for k in range(n):
            changed = leaves[:k] + [sha("x")] + leaves[k + 1 :]
            assert tree.fold(k, sha("x").encode()).decode() == levels(changed)[-1][0]
            assert len(tree.states[0]) == n if n > 1 else not tree.states


def test_places_count_within_keys_across_partitions(spark):
    rows = [("hot", k) for k in range(500)] + [(f"k{k}", j) for k in range(30) for j in range(k % 4 + 1)]
    got = ordered.placed(spark.createDataFrame(rows, "key string, n int").repartition(6), "key", ["n"], "test").collect()
    sizes = {k: sum(a == k for a, _ in rows) for k, _ in rows}
    assert sorted((r["key"], r["n"], r["at"], r["held"]) for r in got) == sorted((k, n, n, sizes[k]) for k, n in rows)


# -- conversation repair ------------------------------------------------------
STEP = {"": "u", "s": "u", "u": "a", "a": "u"}
NAME = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = text.strip(" \t\n\v\f\r")
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired lines) by trying every edit."""

    @cache
    def best(i, state, inserts):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserts < 3:
            cost, audit, lines = best(i, STEP[state], inserts + 1)
            ways.append((cost + 3, "I" + audit, (NAME[STEP[state]] + ":", *lines)))
        if i < len(rows):
            role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + audit, lines))
            if found[i] not in ("blank", "duplicate"):
                more = 3 if found[i] == "truncated" else 0
                if role[:1] == STEP[state] or (role[:1] == "s" and state == ""):
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    ways.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best(i + 1, STEP[state], 0)
                ways.append((cost + more + 3, "R" + audit, (f"{NAME[STEP[state]]}:{text}", *lines)))
        return min(ways) if ways else (10**9, "~", ())

    return best(0, "", 0)


def damaged(rows):
    out, text = [], lambda v: " " if v is None else str(v)
    for conv, turn, role, said in rows:
        role, said = text(role), text(said)
        kind = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        said = "" if kind == 1 else re.sub("[.!?]", "", said) if kind == 2 else said
        out += [(conv, turn, "user" if kind == 4 else role, said)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def repaired(rows):
    """The contract of op12, conversation by conversation."""
    after, out = damaged(rows), []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha(r[3])))
        said = [(r[2], r[3]) for r in own]
        found = faults(said)
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit, lines = cheapest(tuple(said), found)
        cheapest_lines = "\n".join(lines)
        out.append((conv, gaps, *[found.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha(cheapest_lines)))
    return out


REPORT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def random_chat(rng, conv, n):
    roles, texts = ["user", "assistant", "system", "tool", "", None, "sys", "a b"], ["Yes.", "No", "  ", "", None, "Well!\n ", "é", "Ok?", "Ok ?x"]
    weights = [8, 8, 3, 1, 1, 1, 1, 1]
    turns = sorted(rng.choice([None, *range(2 * n + 1)]) or 0 for _ in range(n))
    return [(conv, t if rng.random() > 0.05 else None, rng.choices(roles, weights)[0], rng.choice(texts) if rng.random() < 0.4 else f"Text {rng.randrange(99)}{rng.choice('.!? ')}") for t in turns]


@pytest.mark.parametrize("chunk", [1, 3, 1024])
def test_repair_equals_brute_force(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(repair, "repair", partial(repair.repair, chunk=chunk))
    rng = random.Random(chunk)
    rows = [r for conv in range(150) for r in random_chat(rng, conv, rng.randrange(1, 9))]
    rows += random_chat(rng, None, 6) + random_chat(rng, -7, 60)
    rows += [(conv, 0, "user", "Lone.") for conv in range(500, 560)]  # some lose all they have
    chats = spark.createDataFrame(rows, CHAT).withColumns({"conv": F.lit(1), "AT": F.lit("x"), "kind": F.lit(None)}).repartition(7)
    got = queries.queries()["op12_conversation_repair"](spark, written(tmp_path, chats, "conversations")).select(*REPORT).collect()
    key = lambda r: str(r[0])
    assert sorted(map(tuple, got), key=key) == sorted(repaired(rows), key=key)


def test_repair_of_odd_tables(spark, tmp_path):
    none = spark.createDataFrame([], CHAT)
    assert queries.queries()["op12_conversation_repair"](spark, written(tmp_path, none, "conversations")).count() == 0
    long = "word " * 200_000 + "."
    rows = [(1, 0, "user", long), (1, 1, "assistant", "Yes."), (2, 0, "assistant", "x."), (2, None, None, None)]
    found = repair.repair(spark.createDataFrame(rows, CHAT))
    report = {r["conv_id"]: (r["cost"], r["audit"], r["blank"]) for r in found.report.collect()}
    assert report == {1: (0, "KK", 0), 2: (7, "DIK", 1)}
    texts = [(r["role"], r["text"]) for r in found.rows.where("conv = '=1'").orderBy("step").collect()]
    assert texts == [("user", long), ("assistant", "Yes.")]


def test_ranks_order_nodes_by_their_audits():
    """Doubling ranks nodes as sorting their whole audits does, among nodes of one level."""
    import numpy as np

    rng = np.random.default_rng(5)
    initials = rng.choice([ord(c) for c in "suaax"], (40, 12))
    held = repair.Paths(initials, rng.integers(0, 4, (40, 12)), np.full(40, 12), np.tile(repair.AT_END, (40, 1)))
    held.rank()
    audits = {(g, s): held.path(g, s)[0] for g in range(40) for s in range(4)}
    ranks = {(g, s): held.rank_of[g * 4 + s] for g, s in audits}
    one = sorted(audits, key=lambda n: audits[n])
    assert [audits[n] for n in one] == [audits[n] for n in sorted(audits, key=lambda n: (ranks[n], audits[n]))]
    assert all((ranks[a] == ranks[b]) == (audits[a] == audits[b]) for a, b in zip(one, one[1:]) if len(audits[a]) == len(audits[b]))


# -- byte-pair coding ---------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


def tricky(n):
    rng = random.Random(n)
    parts = ["<|endoftext|>", " ", "  ", "\n", "\t", "'s", "'ll", "a", "b", "é", "日本", "1", "23", ".", "!!", "　", "\x1c", "\x85", "​", "Z" * 70, "😀", "<|", "|>", "endoftext", "\xa0", "́", "\U0003fc3f", "࢏", "՘", "word", "Étion"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_codes_equal_the_library(spark, tmp_path, library):
    texts = [*tricky(3000), None, "", " ", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "ab" * 5000, " " * 3000 + "x", "no space " * 3000]
    docs = spark.createDataFrame([(k if k % 11 else None, t, "en", "s", 0) for k, t in enumerate(texts)], DOCS).withColumn("ids", F.lit(1)).withColumn("TEXT2", F.lit(2))
    got = queries.queries()["op13_bpe"](spark, written(tmp_path, docs.repartition(3), "documents")).collect()
    expected = []
    for k, one in enumerate(library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        back = library.decode(one.ids, skip_special_tokens=False)
        expected.append((k if k % 11 else None, len(one.ids), sha(",".join(map(str, one.ids))), sha(back)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_codes_of_every_kind_of_code_point(library):
    points = [c for c in range(1, 0x110000, 37) if not 0xD800 <= c < 0xE000] + [*range(1, 0x600)]
    texts = [f"a{chr(c)}a 1{chr(c)}1 .{chr(c)}. {chr(c)}{chr(c)}b" for c in points]
    got = bpe.coder().encode(texts)
    assert all(a.tolist() == b.ids for a, b in zip(got, library.encode_batch(texts, add_special_tokens=False)))


def test_decoding_of_ids_that_are_no_text(spark, library):
    rng = random.Random(2)
    ids = [[rng.randrange(50257) for _ in range(rng.randrange(9))] for _ in range(400)] + [[50256, 198, 50256]]
    rows = spark.createDataFrame(list(enumerate(ids)), "doc_id bigint, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in bpe.decoded(rows).collect()}
    assert got == {k: library.decode(one, skip_special_tokens=False) for k, one in enumerate(ids)}
    assert bpe.decoded(spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")).first()["text"] == ""


def test_merge_trees_agree_and_are_bounded(monkeypatch, library):
    """Words side by side and one by one are merged alike; memory of pieces ends at its bound."""
    texts = tricky(400)
    held = bpe.Coder(bpe.VOCABULARY)
    side = held.encode(texts)
    monkeypatch.setattr(bpe, "MANY", 0)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    alone = bpe.Coder(bpe.VOCABULARY)
    one = [alone.encode([t])[0] for t in texts]
    assert [a.tolist() for a in side] == [b.tolist() for b in one]
    assert len(alone.spaced) < 60 and len(alone.bare) < 60


def test_codes_of_no_rows(spark):
    none = spark.createDataFrame([], DOCS)
    assert bpe.decoded(bpe.encoded(none)).count() == 0
    assert bpe._slices(pa.RecordBatch.from_arrays([pa.array([], pa.int64())], ["a"]), pa.array([], pa.int64()), 9) is not None
