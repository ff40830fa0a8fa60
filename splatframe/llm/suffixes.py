"""Exact removal of byte strings that occur more than once, over all texts.

Suffixes are ordered blockwise with a difference cover. With W the length that counts, the cover is a set of residues
modulo v < W such that any two positions have a common distance below v to positions of the cover. So two equal
W-byte strings share a cover sample of W - v + 1 bytes at the same distance from their starts, and

1. the samples' ranks are computed first: each bucket of samples (a range of their hashes) is sorted alone, and tells
   every block of texts which of its samples recur;
2. a suffix that has no recurring sample within distance v can have no equal, whatever its first bytes; the others,
   long ties included, go to suffix buckets by the hash of their first W bytes, again sorted one at a time, so memory
   is bounded by a bucket and not by the corpus.

Only equality to depth W matters here, so ranks are classes of equal strings (64-bit fingerprints of the exact bytes),
not places in the full order. Blocks of texts send each key once with its count, so a string that fills a third of
all texts costs one row a block. Of several copies of one text an elected block sends the suffixes for all.

Null and empty texts and texts shorter than W have nothing to remove. Matches never cross texts; overlapping
occurrences in one text count. Repeated rows remove each other. An empty table gives an empty result.

Shorter passages can be counted on the way: samples are then of their length, and only strings of W bytes in which all
strings of that length recur stay open for the last step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.llm.common import Blocks, answered, ask, discard, free_name, grouped, shards_for, steady, table, text_bytes, text_total, totals, with_row_key, written
from splatframe.llm.cover import Fingerprints, difference_cover

LENGTH = 400
#: The query also counts passages: repeated runs of so many bytes and words, which may be shorter than LENGTH.
PASSAGE_BYTES, PASSAGE_WORDS = 150, 50
#: Bytes of text in a block of the first and of the second step, where each byte may start a suffix to sort; less in
#: proportion for shorter lengths, which have more samples and more ties a byte.
BLOCK_BYTES, TIED_BYTES = 3 << 20, 2 << 20
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
OPEN, PASSAGES = "doc_id long, n_bytes long, sha256 string, weight long, places array<long>, text binary", ", n_passages long, passage_bytes long"


class Texts:
    """A block's texts as one array of bytes."""

    def __init__(self, texts: list[bytes]) -> None:
        self.texts = texts
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1].astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.prints = Fingerprints(self.data)

    def whole(self) -> np.ndarray:
        """A key for each text, apart from all ranges' keys."""
        return np.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "big") for t in self.texts], np.uint64)

    def samples(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions with W - v + 1 bytes after them in their text; and their texts' numbers."""
        v = modulus(length)
        cover, need = difference_cover(v), length - v + 1
        at, of = [], []
        for k in np.flatnonzero(self.sizes >= length):
            p = (np.arange(0, self.sizes[k], v)[:, None] + cover[None, :]).ravel()
            p = p[p + need <= self.sizes[k]]
            at.append(p + self.starts[k])
            of.append(np.full(len(p), k))
        return (np.concatenate(at), np.concatenate(of)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def modulus(length: int) -> int:
    return max(1, length * 273 // 400)


def runs(mask: np.ndarray) -> np.ndarray:
    """(n, 2): starts and ends of the runs of True."""
    return np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))).reshape(-1, 2)


def distinct(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        uniq, _, _, counts = grouped(keys)
        return uniq, counts
    uniq, _, inverse, _ = grouped(keys)
    return uniq, np.bincount(inverse, weights, len(uniq)).astype(np.uint64)


def remove_repeats(docs: DataFrame, length: int = LENGTH, passages: tuple[int, int] | None = None) -> DataFrame:
    """Per row: n_bytes, n_removed, n_spans, kept_sha256, and the removed spans in bytes.

    passages: bytes (length at most) and words; then also n_passages and passage_bytes, number and bytes of the runs
    covered by repeated strings of so many bytes that have so many words. What is removed doesn't depend on that.
    """
    return found_repeats(docs, length, passages)[0]


def found_repeats(docs: DataFrame, length: int, passages: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """remove_repeats() and the table of written() that it reads."""
    least, words = passages or (length, 0)
    if least > length:
        raise ValueError("passages are at most as long as what is removed")
    v, need = modulus(least), least - modulus(least) + 1

    def bounded(size: int, length: int) -> int:
        return max(1 << 18, size * min(length, LENGTH) // LENGTH)

    block_bytes = bounded(BLOCK_BYTES, least)

    def texts_of(rows: pa.Table) -> Texts:
        return Texts([text_bytes(t) for t in rows.column("text").to_pylist()])

    def sample_keys(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        t = texts_of(rows)
        return distinct(np.concatenate([t.prints.of(t.samples(least)[0], need), t.whole()]))

    def candidates(rows: pa.Table, total: np.ndarray, block: str) -> pa.Table:
        """Rows with the places of suffixes that may have an equal: runs (start, end) in the text. Weight 0: another
        row speaks for this text; 2: this row speaks for its copies; the text of rows without places is left out."""
        t = texts_of(rows)
        at, of = t.samples(least)
        keys, whole = t.prints.of(at, need), t.whole()
        known = grouped(np.concatenate([keys, whole]))[0]
        shared = at[total[np.searchsorted(known, keys)] >= 4]
        says = total[np.searchsorted(known, whole)]
        first = np.zeros(len(whole), bool)
        first[np.unique(whole, return_index=True)[1]] = True
        edge = np.zeros(len(t.data) + 1, np.int32)
        begin = np.repeat(t.starts, t.sizes)[shared] if len(shared) else shared
        np.add.at(edge, np.maximum(shared - v + 1, begin), 1)
        np.add.at(edge, shared + 1, -1)
        may = np.cumsum(edge)[:-1] > 0
        weight = np.where(says < 4, 1, np.where((says & np.uint64(1) == 1) & first, 2, 0))
        places = []
        for k, (a, n) in enumerate(zip(t.starts, t.sizes, strict=True)):
            places.append(runs(may[a : a + n - least + 1]).ravel() if n >= least else np.zeros(0, np.int64))
        held = [zstandard.compress(x, 3) if len(p) else None for x, p in zip(t.texts, places, strict=True)]
        digest = [hashlib.sha256(x).hexdigest() for x in t.texts]
        return pa.table({"doc_id": rows.column("doc_id"), "n_bytes": pa.array(t.sizes), "sha256": digest, "weight": pa.array(weight, pa.int64()), "places": pa.array(places, pa.list_(pa.int64())), "text": pa.array(held, pa.binary())})

    def windows(rows: pa.Table) -> tuple[Texts, np.ndarray, np.ndarray]:
        t = Texts([zstandard.decompress(z) for z in rows.column("text").to_pylist()])
        at = [np.concatenate([np.arange(a, b) for a, b in np.array(p).reshape(-1, 2)]) + s for p, s in zip(rows.column("places").to_pylist(), t.starts, strict=True)]
        weights = np.repeat(rows.column("weight").to_numpy(), [len(x) for x in at])
        return t, np.concatenate(at), weights

    def window_keys(rows: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray]:
        t, at, weights = windows(rows)
        speak = weights > 0
        return distinct(t.prints.of(at[speak], length), weights[speak])

    def repeated(rows: pa.Table, total: np.ndarray, length: int) -> tuple[Texts, np.ndarray, np.ndarray]:
        """The block's texts, where repeated strings start, and the bytes they cover."""
        t, at, weights = windows(rows)
        keys, speak = t.prints.of(at, length), weights > 0
        known = grouped(keys[speak])[0]
        twice = ~speak  # a text with copies is removed whole
        twice[speak] = total[np.searchsorted(known, keys[speak])] >= 4
        edge = np.zeros(len(t.data) + 1, np.int32)
        np.add.at(edge, at[twice], 1)
        np.add.at(edge, at[twice] + length, -1)
        return t, at[twice], np.cumsum(edge)[:-1] > 0

    def narrow(rows: pa.Table, total: np.ndarray, block: str) -> pa.Table:
        """Counts passages, and leaves the places where strings of the full length may have an equal."""
        t, at, covered = repeated(rows, total, least)
        start = np.zeros(len(t.data), bool)
        start[at] = True
        places, read = [], []
        for x, a, n in zip(t.texts, t.starts, t.sizes, strict=True):
            p = runs(start[a : a + n]) - np.array([0, length - least])
            places.append(p[p[:, 0] < p[:, 1]].ravel())
            read.append([int(e - b) for b, e in runs(covered[a : a + n]) if len(x[b:e].split()) >= words])
        held = [z if len(p) else None for z, p in zip(rows.column("text").to_pylist(), places, strict=True)]
        new = {"places": pa.array(places, pa.list_(pa.int64())), "text": pa.array(held, pa.binary()), "n_passages": pa.array([len(r) for r in read], pa.int64()), "passage_bytes": pa.array([sum(r) for r in read], pa.int64())}
        return pa.table({name: rows.column(name) for name in ("doc_id", "n_bytes", "sha256", "weight")} | new)

    def cut(rows: pa.Table, total: np.ndarray, block: str) -> pa.Table:
        t, _, gone = repeated(rows, total, length)
        out = []
        for x, a, n in zip(t.texts, t.starts, t.sizes, strict=True):
            spans, kept, last = runs(gone[a : a + n]), hashlib.sha256(), 0
            for b, e in spans:
                kept.update(x[last:b])
                last = e
            kept.update(x[last:])
            out.append((int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest(), [{"start": int(b), "end": int(e)} for b, e in spans]))
        removed, n_spans, sha, spans = zip(*out, strict=True)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": rows.column("doc_id"), "n_bytes": pa.array(t.sizes), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": list(sha), "spans": pa.array(spans, span)} | {name: rows.column(name) for name in counted})

    docs = steady(docs.select(F.col("doc_id").cast("long"), "text"))
    n_bytes = text_total(docs)
    blocks = Blocks(docs, block_bytes)
    shards = shards_for(n_bytes, 1.2 * len(difference_cover(v)) / v)
    ranks = totals(ask(blocks, sample_keys, shards), shards, n_bytes // block_bytes + 1, elect=True)
    rows, counted = written(answered(blocks, ranks, candidates, OPEN)), []

    def judged(rows: DataFrame, length: int, use: Callable[[pa.Table, np.ndarray, str], pa.Table], schema: str) -> DataFrame:
        tied, tied_bytes = rows.filter("text is not null"), bounded(TIED_BYTES, length)
        n_tied = text_total(tied, "n_bytes")
        open_ = Blocks(tied, tied_bytes, level=1, size="n_bytes")
        shards = shards_for(n_tied, 0.8)
        return answered(open_, totals(ask(open_, lambda rows: window_keys(rows, length), shards), shards, n_tied // tied_bytes + 1), use, schema)

    if passages:
        none = [F.lit(0).cast("long").alias(name) for name in ("n_passages", "passage_bytes")]
        scratch, rows = rows, written(rows.filter("text is null").select("*", *none).unionByName(judged(rows, least, narrow, OPEN + PASSAGES)))
        discard(scratch)
        counted = ["n_passages", "passage_bytes"]
    done = rows.filter("text is null").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha256").alias("kept_sha256"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), *counted)
    return done.unionByName(judged(rows.drop("sha256"), length, cut, RESULT + PASSAGES * bool(passages))), rows


def without_repeats(docs: DataFrame, length: int = LENGTH, least_words: int = 0) -> DataFrame:
    """docs with every repeated span (of at least least_words words) cut out of text, and n_chars (if any) set anew,
    whether or not rows share a doc_id.

    Of a string that occurs several times the occurrences in the row with the smallest doc_id are not spared: as in
    remove_repeats(), every occurrence goes. Characters cut in part by a span go whole.
    """
    keyed, key = with_row_key(docs)
    cuts_at = free_name(keyed, "_spans")
    found, scratch = found_repeats(keyed.select(F.col(key).alias("doc_id"), "text"), length)
    # written, so that the steps' shuffles and scratch texts are gone before texts are shuffled to meet their spans
    spans = written(found.filter("n_removed > 0").select(F.col("doc_id").alias(key), F.col("spans").alias(cuts_at)))
    discard(scratch)
    joined = keyed.join(spans, key, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, cuts in zip(batch.column("text").to_pylist(), batch.column(cuts_at).to_pylist(), strict=True):
                if cuts:
                    data, parts, last = text_bytes(text), [], 0
                    for s in (s for s in cuts if len(data[s["start"] : s["end"]].split()) >= least_words):
                        parts.append(data[last : s["start"]].decode("utf-8", "ignore"))
                        last = s["end"]
                    text = "".join([*parts, data[last:].decode("utf-8", "ignore")])
                texts.append(text)
            k = batch.schema.get_field_index("text")
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type)).drop_columns([cuts_at])

    out = joined.select(*docs.columns, cuts_at).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), LENGTH, (PASSAGE_BYTES, PASSAGE_WORDS)).drop("spans")
