"""Repeated byte strings against a scan of every string of the length."""

import hashlib
import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from splatframe.llm import cover, suffixes
from splatframe.llm.common import BATCH_BYTES, Blocks, ask, pack_ints, pack_sorted, splitmix, steady, totals, unpack_ints, written
from splatframe.llm.cover import difference_cover


def slow(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length", [3, 20, 41])
def test_repeats_are_removed_exactly(spark, length):
    rnd = random.Random(length)
    passages = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randrange(length - 2, 3 * length))) for _ in range(8)]
    rows = [(0, None), (1, ""), (2, "z" * (length - 1)), (3, "ab" * (2 * length)), (4, "y" * length), (5, "y" * length)]
    for i in range(6, 60):
        text = "".join(rnd.choice([*passages, "".join(rnd.choice("efghij") for _ in range(2 * length))]) for _ in range(rnd.randrange(1, 5)))
        rows.append((i, text if rnd.random() < 0.8 else text[: len(text) // 2] + "Q" + text[len(text) // 2 :]))
    rows += [(60, rows[20][1]), (60, rows[20][1])]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_bytes int, places string").repartition(5)
    got = suffixes.remove_repeats(df, length)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == slow(rows, length)


@pytest.mark.parametrize(("length", "least"), [(41, 20), (41, 3), (20, 20)])
def test_passages_and_what_is_removed_are_judged_apart(spark, length, least):
    rnd = random.Random(length + least)
    passages = ["".join(rnd.choice("abcdé  ") for _ in range(rnd.randrange(least - 2, 2 * length))) for _ in range(9)]
    rows = [(0, None), (1, ""), (2, "z" * (least - 1)), (3, "a b" * length), (4, "y " * (length // 2)), (5, "y " * (length // 2))]
    for i in range(6, 60):
        rows.append((i, "".join(rnd.choice([*passages, "".join(rnd.choice("efghij ") for _ in range(2 * length))]) for _ in range(rnd.randrange(1, 5)))))
    rows += [(60, rows[20][1]), (60, rows[20][1]), (None, rows[21][1])]
    seen, want = Counter(b[k : k + least] for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - least + 1)), []
    for i, t in rows:
        b, gone = (t or "").encode(), []
        gone = [any(seen[b[k : k + least]] > 1 for k in range(max(0, j - least + 1), min(j, len(b) - least) + 1)) for j in range(len(b))]
        found = [b[s:e] for s, e in suffixes.runs(np.array(gone, bool))]
        want.append((repr(i), sum(len(x.split()) >= 4 for x in found), sum(len(x) for x in found if len(x.split()) >= 4)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffixes.remove_repeats(df, length, (least, 4)).collect()
    assert sorted((repr(r.doc_id), r.n_passages, r.passage_bytes) for r in got) == sorted(want)
    plain = [(-1 if i is None else i, t) for i, t in rows]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow(plain, length)
    assert suffixes.remove_repeats(df.limit(0), length, (least, 4)).count() == 0


def test_query_counts_passages_of_over_50_words_below_400_bytes(spark, tmp_path):
    """They are left by the contract's columns, which speak of strings of 400 bytes, and counted beside them."""
    rnd = random.Random(5)
    words = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    short, line, long = words(55), words(30), words(90)
    texts = [f"{words(40)} {p} {words(40)}" for p in (short, short, line, line, long, long)] + [words(120), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = sorted(suffixes.query(spark, f"file://{tmp_path}").collect())
    assert [(r.n_removed > 0, r.n_passages) for r in got] == [(False, 1)] * 2 + [(False, 0)] * 2 + [(True, 1)] * 2 + [(False, 0)] * 2
    assert all(len(short) <= r.passage_bytes <= len(short) + 4 for r in got[:2]) and got[4].passage_bytes == got[4].n_removed
    assert [tuple(r)[:5] for r in got] == slow(list(enumerate(texts)), 400)


def test_empty_table_and_cut_texts(spark):
    df = spark.createDataFrame([(1, "a" * 30 + "bcdefé", 0), (2, "x" + "a" * 12, 0), (3, None, 0)], "doc_id long, text string, n_chars long")
    assert suffixes.remove_repeats(df.limit(0), 10).count() == 0
    assert sorted((r.doc_id, r.text, r.n_chars) for r in suffixes.without_repeats(df, 10).collect()) == [(1, "bcdefé", 6), (2, "x", 1), (3, None, None)]


@pytest.mark.parametrize("v", [1, 2, 7, 31, 64, 273])
def test_difference_covers(v):
    d = difference_cover(v)
    assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_fingerprints_do_not_depend_on_the_block_and_keep_no_tables():
    """Idle workers hold what a module keeps: nothing of a block's size may stay."""
    text = bytes(range(256)) * 9
    prints = [cover.Fingerprints(np.frombuffer(b"x" * n + text, np.uint8)).of(np.arange(n, n + 1900), 400) for n in (0, 1, 5000, 70000)]
    assert all((p == prints[0]).all() for p in prints) and (prints[0][:256] == prints[0][256:512]).all() and len(set(prints[0][:256])) == 256
    assert not [k for k, f in vars(cover).items() if hasattr(f, "cache_info") and k != "difference_cover"]


@pytest.mark.parametrize("order", ["abc", "cba", "bca"])
def test_election_does_not_depend_on_arrival(spark, order):
    keys = {"a": [7], "b": [5, 7], "c": [5, 7, 9]}
    rows = [(b, 0, bytearray(pack_sorted(np.array(keys[b], np.uint64))), bytearray(pack_ints(np.ones(len(keys[b]), np.uint64)))) for b in order]
    asked = spark.createDataFrame(rows, "block string, shard int, keys binary, counts binary").coalesce(1)
    got = {r.block: unpack_ints(bytes(r.totals)).tolist() for r in totals(asked, 1, 3, elect=True).collect()}
    assert got == {"a": [7], "b": [5, 6], "c": [4, 6, 3]}


@pytest.mark.parametrize("shards", [3, 7, 40])
def test_counts_in_levels_are_the_same(spark, tmp_path, shards):
    """Teams of blocks that add up first give the counts that one level gives, and elect one block for each key."""
    spark.range(0, 600, 1, 3).selectExpr("id", "cast(id % 97 as string) as text").write.parquet(f"file://{tmp_path}/t")
    blocks = Blocks(steady(spark.read.parquet(f"file://{tmp_path}/t")), 25)

    def keys(rows):
        return np.unique(splitmix(np.array([int(t) for t in rows.column("text").to_pylist()], np.uint64)), return_counts=True)

    def flat(fan):
        found = totals(ask(blocks, keys, shards, fan), shards, 50, elect=True, fan=fan).orderBy("block", "shard").collect()
        out = {}
        for r in found:
            out.setdefault(r.block, []).extend(unpack_ints(bytes(r.totals)).tolist())
        return out

    one, many = flat(64), flat(3)
    assert {b: [x >> 1 for x in v] for b, v in one.items()} == {b: [x >> 1 for x in v] for b, v in many.items()}
    assert sum(x & 1 for v in one.values() for x in v) == sum(x & 1 for v in many.values() for x in v) == 97
    assert len(one) > 20 and spark.range(3).count() == 3


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    out = set()
    while found.hasNext():
        if (f := found.next()).getName().endswith(".data"):
            out.add(f.getName())
    return out


def test_shuffles_and_scratch_texts_go_once_a_table_is_written(spark):
    """They took disk beside the next step's until the driver collected its garbage."""
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffle_files(spark)
    held = spark.conf.get(key)
    table = written(spark.range(0, 5000, 1, 3).selectExpr("id % 700 as k").groupBy("k").count())
    for _ in range(50):
        if not (more := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not more and spark.conf.get(key) == held and table.count() == 700
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    scratch = set(shared.glob("scratch-*"))
    df = spark.createDataFrame([(i, chr(65 + i) + " repeated words" * 9) for i in range(20)], "doc_id long, text string")
    out = suffixes.without_repeats(written(df), 40)
    left = [x for x in set(shared.glob("scratch-*")) - scratch if "sha256" in str(spark.read.parquet(f"file://{x}").columns)]
    assert not left and {r.text.strip() for r in out.collect()} == {chr(65 + i) for i in range(20)}


def test_batches_with_texts_are_bounded_by_bytes(spark, tmp_path):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key)
    try:
        spark.range(0, 4000, 1, 1).selectExpr("id as doc_id", "repeat('x', 10000) as text").write.parquet(f"file://{tmp_path}/t")
        blocks = Blocks(steady(spark.read.parquet(f"file://{tmp_path}/t")), 1 << 20)
        spark.conf.set(key, str(64 << 20))
        assert blocks.rows().count() == 39
        most = blocks.docs.mapInPandas(lambda frames: (f.agg({"doc_id": ["count"]}).set_axis(["n"], axis=1) for f in frames), "n long").agg({"n": "max"}).first()[0]
        assert most * 10000 < BATCH_BYTES + 20000
        spark.conf.set(key, "1m")
        blocks.rows()
        assert spark.conf.get(key) in ("1m", "1048576", "1048576b")
    finally:
        spark.conf.set(key, held)
