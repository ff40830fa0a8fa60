"""What several operators share: scratch tables, text blocks, sharded key counts, connected components."""

from __future__ import annotations

import ctypes
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text in one block; a longer document is a block of its own.
BLOCK_BYTES = 8 << 20
#: Keys of one count shard; the number of shards follows from the size of the input.
SHARD_KEYS = 1 << 21
#: Bytes of an Arrow batch that goes to a Python worker with texts.
BATCH_BYTES = 4 << 20
_LIBC = ctypes.CDLL(None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share. Where that is unset, a local session (one
    machine, as in tests) sets its own; a cluster has to name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jvm_dir.isDefined():
            base = jvm_dir.get()
        elif re.match(r"local($|\[)", spark.sparkContext.master):
            base = "file:///tmp/checkpoints"
            spark.sparkContext.setCheckpointDir(base)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base}/scratch-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


@contextmanager
def held_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame) -> DataFrame:
    """Writes df to a table in the shared folder and reads it back, which cuts its lineage. The job's shuffle files are
    deleted once it is written, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    with held_conf(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes a table of written() that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes: a batch of 10,000 texts is held by the executor and its worker all
    the while that blocks are made of its rows. A smaller bound that is set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def free_name(docs: DataFrame, name: str) -> str:
    """name, with underscores before it until no column of docs has it."""
    there = {c.lower() for c in docs.columns}
    while name.lower() in there:
        name = f"_{name}"
    return name


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with another column that no two rows share, and its name: doc_id where it does that, else a number
    written with the rows."""
    key = free_name(docs, "_row")
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    if ids.groupBy("id").count().filter("count > 1 or id is null").isEmpty():
        return docs.withColumn(key, F.col("doc_id").cast("long")), key
    return written(docs.withColumn(key, F.monotonically_increasing_id())), key


def splitmix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: a bijection of uint64 values."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """np.unique() of well-mixed uint64 keys: distinct keys, their first places, each key's group, the groups' sizes.

    Sorts the keys' high bits together with their places as one number, and falls back where high bits collide.
    """
    bits = np.uint64(max(1, len(keys).bit_length()))
    low = np.uint64((1 << int(bits)) - 1)
    both = keys & ~low
    both |= np.arange(len(keys), dtype=np.uint32 if len(keys) < 1 << 32 else np.uint64)
    both.sort()
    place = np.empty(len(keys), np.int32 if len(keys) < 1 << 31 else np.int64)
    np.bitwise_and(both, low, out=place, casting="unsafe")  # without another array of the keys' size
    both >>= bits
    new = np.ones(len(keys), bool)
    np.not_equal(both[1:], both[:-1], out=new[1:])
    del both
    ordered = keys[place]
    if bool(((ordered[1:] != ordered[:-1]) & ~new[1:]).any()):
        return np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(new)
    uniq, first = ordered[starts], place[starts]
    del ordered
    inverse = np.empty(len(keys), place.dtype)
    inverse[place] = np.cumsum(new, dtype=place.dtype) - 1
    return uniq, first, inverse, np.diff(np.append(starts, len(keys)))


def trim() -> None:
    """Gives memory that was freed back to the system: idle Python workers keep it otherwise, next to those at work."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def text_bytes(text: str | None) -> bytes:
    """UTF-8; null counts as empty, and a lone surrogate as '?'."""
    return (text or "").encode("utf-8", "replace")


# ---------------------------------------------------------------- packed arrays

_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys as byte planes of their differences, so the high planes vanish when compressed."""
    step = np.diff(keys, prepend=np.uint64(0))
    return _ZIP.compress(np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_UNZIP.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_ints(values: np.ndarray) -> bytes:
    return _ZIP.compress(np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_UNZIP.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def unpack_all(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([unpack_ints(x) for x in parts]) if parts else np.zeros(0, np.uint64)


# ---------------------------------------------------------------- blocks of documents


def steady(docs: DataFrame) -> DataFrame:
    """docs if every reading of it gives the same rows in the same places, else a written copy."""
    run = docs._jdf.queryExecution()
    nodes = re.findall(r"^[ :+*()0-9-]*([A-Za-z ]*[A-Za-z])", run.sparkPlan().toString(), re.M)
    fixed = all(re.match(r"(Project|Filter|FileScan|Scan parquet|Scan ExistingRDD|LocalTableScan|Range)\b", n) for n in nodes)
    return docs if fixed and run.optimizedPlan().deterministic() else written(docs)


class Blocks:
    """Rows of docs in blocks, in the order read, without a shuffle.

    A block is filled by the bytes of its texts before compression (or by the column `size`); a longer text is a block
    of its own. It is named by its place in docs and a digest of its rows, so it has the same name whenever it is made
    again (docs must be steady()), and nothing is written for that. Rows for which deal(batch) is true and others
    are in different blocks.
    """

    def __init__(self, docs: DataFrame, block_bytes: int = BLOCK_BYTES, level: int = 9, size: str | None = None, deal: Callable[[pa.RecordBatch], np.ndarray] | None = None) -> None:
        self.docs, self.block_bytes, self.level, self.size, self.deal = docs, block_bytes, level, size, deal

    def over(self, use: Callable[[str, pa.Buffer], pa.RecordBatch | None], schema: str) -> DataFrame:
        """The rows that use(name, Arrow stream of the block) makes of each block."""
        block_bytes, size, deal = self.block_bytes, self.size, self.deal
        small_batches(self.docs.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: tuple[list[pa.RecordBatch], list[pa.RecordBatch]] = ([], [])
            filled, made = [0, 0], 0

            def done(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
                out = io.BytesIO()
                with pa.ipc.new_stream(out, rows[0].schema) as w:
                    for b in rows:
                        w.write_batch(b)
                rows.clear()
                data = pa.py_buffer(out.getbuffer())
                return use(f"{hashlib.blake2b(data, digest_size=8).hexdigest()}-{TaskContext.get().partitionId()}-{made}", data)

            def parts(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
                if deal is None:
                    yield 0, batch
                elif batch.num_rows:
                    ones = deal(batch)
                    yield 0, batch.filter(pa.array(~ones))
                    yield 1, batch.filter(pa.array(ones))

            for whole in batches:
                for k, batch in parts(whole):
                    at = 0
                    column = batch.column(size) if size else pa.compute.binary_length(batch.column("text"))
                    sizes = np.asarray(pa.compute.fill_null(column, 0)) if batch.num_rows else np.zeros(0)
                    for i, n in enumerate(sizes):
                        if filled[k] and filled[k] + int(n) > block_bytes:
                            if i > at:
                                held[k].append(batch.slice(at, i - at))
                            if (out := done(held[k])) is not None:
                                yield out
                            filled[k], made, at = 0, made + 1, i
                        filled[k] += int(n)
                    if batch.num_rows > at:
                        held[k].append(batch.slice(at))
            for rows in held:
                if rows and (out := done(rows)) is not None:
                    yield out
                made += 1
            trim()

        return self.docs.mapInArrow(run, schema)

    def rows(self) -> DataFrame:
        """(block, payload): each block under its name, compressed."""
        level = self.level
        return self.over(lambda name, data: pa.RecordBatch.from_pydict({"block": [name], "payload": pa.array([zstandard.compress(data, level)], pa.binary())}), "block string, payload binary")


def opened(data: pa.Buffer | bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def text_total(docs: DataFrame, size: str | None = None) -> int:
    """Bytes of all texts, by which shards are numbered."""
    return docs.agg(F.sum(F.col(size) if size else F.octet_length("text"))).first()[0] or 0


# ---------------------------------------------------------------- sharded key counts

Keys = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]
#: Key ranges to which one block (or team of blocks) sends rows: a row for a kilobyte or so of its text.
FAN = 8192


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the key space, so that a sorted array falls into slices."""
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def sliced(block: str, k: np.ndarray, c: np.ndarray, shards: int) -> dict[str, list]:
    """Rows (block, shard, keys, counts) of the ranges in which the sorted keys k lie."""
    of = shard_of(k, shards)
    begin = np.flatnonzero(np.diff(of, prepend=np.uint64(shards + 1)))
    ends = np.append(begin[1:], len(k))
    return {"block": [block] * len(begin), "shard": pa.array(of[begin].astype(np.int64)), "keys": pa.array([pack_sorted(k[a:b]) for a, b in zip(begin, ends, strict=True)], pa.binary()), "counts": pa.array([pack_ints(c[a:b]) for a, b in zip(begin, ends, strict=True)], pa.binary())}


def ask(blocks: Blocks, keys: Keys, shards: int, fan: int = FAN) -> DataFrame:
    """(block, shard, keys, counts): each block's distinct keys with their counts, pre-aggregated before the shuffle;
    over `fan` ranges at most, which totals() divides further."""

    def use(name: str, data: pa.Buffer) -> pa.RecordBatch | None:
        k, c = keys(opened(data))
        return pa.RecordBatch.from_pydict(sliced(name, k, c, min(shards, fan))) if len(k) else None

    return blocks.over(use, ASKED)


ASKED, ANSWER = "block string, shard long, keys binary, counts binary", "block string, shard long, totals binary"


def merged(group: pa.Table) -> tuple[list[str], list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names and numbers of keys of a group's rows by name, not in the order of arrival, which changes from run to run;
    distinct keys, their first places, each key's group and the sums of counts."""
    names, asked_, seen = group.column("block").to_pylist(), group.column("keys"), group.column("counts")
    order = sorted(range(len(names)), key=names.__getitem__)
    parts = [unpack_sorted(asked_[i].as_py()) for i in order]
    sizes, keys = [len(p) for p in parts], np.concatenate(parts)
    del parts
    uniq, first, inverse, _ = grouped(keys)
    del keys
    total, at = np.zeros(len(uniq), np.uint64), 0
    for i, n in zip(order, sizes, strict=True):  # counts are unpacked row by row, not held beside the keys
        np.add.at(total, inverse[at : at + n], unpack_ints(seen[i].as_py()))
        at += n
    return [names[i] for i in order], sizes, uniq, first, inverse, total


def handed_back(names: list[str], sizes: list[int], shard: int, back: np.ndarray) -> pa.Table:
    out, at = [], 0
    for n in sizes:
        out.append(pack_ints(back[at : at + n]))
        at += n
    trim()
    return pa.table({"block": pa.array(names, pa.string()), "shard": pa.array([shard] * len(names), pa.int64()), "totals": pa.array(out, pa.binary())})


def totals(asked: DataFrame, shards: int, n_blocks: int, elect: bool = False, fan: int = FAN, here: int = 0) -> DataFrame:
    """(block, shard, totals): for each block's keys, in their order, twice the count over all blocks, plus 1 (if
    asked for) for the one block that is elected to speak for the key: the same whenever a shard is computed again.

    A shard is sorted alone, so memory is bounded by its size. With more shards than `fan` ranges, teams of `fan`
    blocks add up their counts first and send those on to finer ranges, level by level; so the rows sent grow in
    proportion to the blocks and not to blocks times shards. here: the ranges that asked has.
    """
    here = here or min(shards, fan)
    if shards <= here:

        def run(group: pa.Table) -> pa.Table:
            names, sizes, _, first, inverse, total = merged(group)
            total *= np.uint64(2)
            back = total[inverse]
            del inverse, total
            if elect:
                back[first] += np.uint64(1)
            return handed_back(names, sizes, group.column("shard")[0].as_py(), back)

        return asked.groupBy("shard").applyInArrow(run, ANSWER)
    teams, per = -(-n_blocks // fan), min(fan, -(-shards // here))

    def team_up(group: pa.Table) -> pa.Table:
        _, _, uniq, _, _, total = merged(group)
        return pa.table(sliced(f"{here}-{group.column('team')[0].as_py()}", uniq, total, here * per))

    def spread(left: pa.Table, right: pa.Table) -> pa.Table:
        names, sizes, _, first, inverse, _ = merged(left)
        got = dict(zip(right.column("shard").to_pylist(), right.column("totals").to_pylist(), strict=True))
        known = unpack_all([got[k] for k in sorted(got)])
        back = known[inverse] & ~np.uint64(1)
        back[first] += known & np.uint64(1)
        return handed_back(names, sizes, left.column("shard")[0].as_py(), back)

    dealt = asked.withColumn("team", F.pmod(F.xxhash64("block"), F.lit(teams)))
    above = totals(dealt.groupBy("shard", "team").applyInArrow(team_up, ASKED), shards, teams, elect, fan, here * per)
    back = above.select(F.split_part("block", F.lit("-"), F.lit(2)).cast("long").alias("team"), F.expr(f"shard div {per}").alias("over"), "shard", "totals")
    return dealt.groupBy("shard", "team").cogroup(back.groupBy("over", "team")).applyInArrow(spread, ANSWER)


def answered(blocks: Blocks, totals_: DataFrame, use: Callable[[pa.Table, np.ndarray, str], pa.Table], schema: str, unpack: Callable | None = None) -> DataFrame:
    """Brings each block's totals back to its rows; use(rows, totals in the order of the block's sorted keys, block)."""
    unpack = unpack or unpack_all

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise RuntimeError("a block was not made again as it was: docs changed between two readings")
        order = np.argsort(np.asarray(right.column("shard"))) if right.num_rows else []
        got = right.column("totals").to_pylist() if right.num_rows else []
        out = use(opened(zstandard.decompress(left.column("payload")[0].as_py())), unpack([got[i] for i in order]), left.column("block")[0].as_py())
        trim()
        return out

    return blocks.rows().groupBy("block").cogroup(totals_.groupBy("block")).applyInArrow(run, schema)


def shards_for(n_bytes: int, keys_per_byte: float) -> int:
    return max(16, int(n_bytes * keys_per_byte / SHARD_KEYS) + 1)


# ---------------------------------------------------------------- connected components


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, component): smallest node reachable over links (a, b), for every node that has a link.

    Alternating large-star and small-star rounds (Kiveris et al., 2014), each written to the shared folder, until every
    node has one edge or is the end of some; every round's groups are folded by min(), so one hot node is
    pre-aggregated before the shuffle.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    for _ in range(most):
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
        if ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("low")).filter("ups > 1 or ups = 1 and low = 0").isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        edges = written(small)
    else:
        raise RuntimeError("components() did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
