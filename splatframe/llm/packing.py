"""Best-fit packing of token pieces into fixed-size sequences.

Pieces above a third of the capacity can share a sequence with at most one other of their kind: they are paired
by greedy matching, largest first, each with the largest partner that fits. Smaller pieces then go, in falling
order, to the tightest remaining gap. The plan needs only how many pieces have each length (at most `capacity`
numbers), so it is made on the driver in runs of equal lengths and applied by rank; no document is gathered.

Null and empty texts are one end token. Repeated rows and ids are packed like any others. An empty table gives
an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splatframe.llm.common import table, written

CAPACITY, END_ID = 4096, 1
#: Hash groups in which pieces of one length are numbered: so many, or more where a group would hold more than RANK_ROWS
#: pieces, so that a common length is not numbered by one task and groups don't grow with the input.
RANK_GROUPS, RANK_ROWS = 16, 1 << 18
CACHED_WORDS = 600_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

#: The word pattern and special tokens of the word-level vocabulary file. Texts with other than these
#: characters (or with a possible special token) are normalised and split by the library; for these the classes of
#: letters and digits are written out.
UNUSUAL = re.compile(r"[^\t\n\r -~¡-ſ‐-‧€]|<\|")
LETTERS, DIGITS = "a-zªµºß-öø-ÿĀ-ſ", "0-9²³¹¼-¾"
WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\s{LETTERS}{DIGITS}]+")
#: Characters of text whose new words are sent to the library in one call.
CALL_CHARS = 1 << 20


class WordIds(dict):
    """Word -> its ids as little-endian uint32 bytes, found by the tokenizers library on first sight."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)  # ids that end a word
        for token, i in self.tokenizer.get_vocab().items():
            self.last[i] = token.endswith("</w>")

    def library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self, words: set[str]) -> None:
        """Encodes words together, since none depends on its neighbours, and cuts the ids where words end."""
        if len(self) + len(words) > CACHED_WORDS:
            self.clear()
        if new := [w for w in words if w not in self]:
            ids = self.library(" ".join(new))
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(new):
                raise ValueError("the vocabulary doesn't mark the ends of words")
            data, at = ids.tobytes(), 0
            for w, end in zip(new, (4 * ends).tolist(), strict=True):
                self[w] = data[at:end]
                at = end

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        while len(out) < len(texts):
            some, size = [], 0
            while size < CALL_CHARS and len(out) + len(some) < len(texts):
                text = texts[len(out) + len(some)]
                size += len(text)
                some.append(text if UNUSUAL.search(text) else WORDS.findall(unicodedata.normalize("NFC", text).lower()))
            self.learn(set().union(*(x for x in some if isinstance(x, list))))
            out += [self.library(x).tobytes() if isinstance(x, str) else b"".join(map(self.__getitem__, x)) for x in some]
        return out


@functools.cache
def word_ids(path: str) -> WordIds:
    """One for each Python worker, which keeps what it has learnt from task to task."""
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: each text's ids and the end id, cut at `capacity` only where longer."""
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), words.ids([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                data = memoryview(ids + tail)
                for k, at in enumerate(range(0, len(data) // 4, capacity)):
                    cut = data[4 * at : 4 * (at + capacity)]
                    rows.append((doc, k, at, len(cut) // 4, zlib.crc32(cut)))
            d, k, s, n, c = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(k, pa.int32()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(c, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, number, first sequence, offset) and the number of sequences.

    Of the pieces of a length, those ranked first..first+number-1 go to successive sequences at the same offset.
    """
    left = {n: c for n, c in counts.items() if c}
    ranks: dict[int, int] = dict.fromkeys(left, 0)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by free space: (first sequence, number)
    runs, opened = [], 0

    def place(n: int, number: int, sequence: int, offset: int) -> None:
        runs.append((n, ranks[n], number, sequence, offset))
        ranks[n] += number
        left[n] -= number

    for n in sorted((n for n in left if 3 * n > capacity), reverse=True):
        partners = sorted((m for m in left if 3 * m > capacity and m <= min(n, capacity - n)), reverse=True)
        for m in [*partners, 0]:
            number = left[n] // 2 if m == n else min(left[n], left[m]) if m else left[n]
            if number:
                place(n, number, opened, 0)
                if m:
                    place(m, number, opened, n)
                gaps[capacity - n - m].append((opened, number))
                opened += number
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in range(n, capacity + 1):
            # a gap that this length makes by filling a wider one is tighter, so it is filled before the next wider
            todo = [(gap, *x) for x in gaps[gap]]
            if not todo or not left[n]:
                continue
            gaps[gap] = []
            while todo:
                free, first, number = todo.pop()
                take = min(number, left[n]) if free >= n else 0
                if take < number:
                    gaps[free].append((first + take, number - take))
                if take:
                    place(n, take, first, capacity - free)
                    todo.append((free - n, first, take))
        each = capacity // n
        for number, height in ((left[n] // each, each), (1, left[n] % each)):
            if number and height:
                for k in range(height):
                    place(n, number, opened, k * n)
                gaps[capacity - height * n].append((opened, number))
                opened += number
    return runs, opened


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces that have doc_id, piece and length."""
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}  # a row per length: `capacity` at most
    groups = parts.sparkSession.createDataFrame([(n, max(RANK_GROUPS, -(-c // RANK_ROWS))) for n, c in counts.items()], "length long, _groups long")
    names = parts.columns
    parts = parts.join(F.broadcast(groups), "length").withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_groups"))).select(*names, "_group")
    sizes = parts.groupBy("length", "_group").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = written(sizes.select("length", "_group", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    runs, _ = plan(counts, capacity)
    runs = np.array(sorted(runs), np.int64).reshape(-1, 5)
    starts = runs[:, 0] << 44 | runs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "_rank"))
            at = np.searchsorted(starts, n << 44 | rank, "right") - 1
            out = {c: batch.column(c) for c in names} | {"sequence_id": pa.array(runs[at, 3] + rank - runs[at, 1]), "offset": pa.array(runs[at, 4])}
            yield pa.RecordBatch.from_pydict(out)

    order = Window.partitionBy("length", "_group").orderBy("doc_id", "piece")
    ranked = parts.withColumn("_in", F.row_number().over(order)).join(sizes.drop("_n"), ["length", "_group"]).withColumn("_rank", F.col("_before") + F.col("_in") - 1)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema if f.name in names) + ", sequence_id long, offset long"
    return ranked.select(*names, "_rank").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with the sequence and the place they are packed to."""
    return pack(written(pieces(docs, tokenizer_path, capacity, end_id)), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
