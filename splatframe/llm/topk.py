"""Exact top-k by inner product with vector-approximation files.

Vectors are packed in blocks: ids, 4-bit cell codes per dimension (the grid spans the block's own range), and the
exact integers. A query bounds every vector's score from its cells, then reads exact vectors in the order of those
bounds until the k-th best score is above the next bound. Blocks of queries meet groups of vector blocks by an
equi-join on an explicit group number; each meeting keeps k rows a query, and the last step merges these.

Components become floor(64 * x). Vectors that are null or hold null, NaN or infinite components take no part, nor do
empty ones. Missing components of shorter vectors count as 0. Ties go to the smaller id. Scores beyond 64 bits are
cut to that range after ranking. Rows whose id is null take no part. Repeated ids are rows of their own, except that
a query never meets rows of its own id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splatframe.llm.common import table, written

SCALE, K, BITS, BLOCK = 64, 20, 4, 4096
#: Vectors in one group and queries in one group: the two sides of one task's work.
GROUP_VECTORS, GROUP_QUERIES = 8192, 16_384
CELLS = 1 << BITS


def integers(values: list) -> np.ndarray | None:
    """floor(64 * x) as int64, or as Python integers where that overflows; None if the vector takes no part."""
    if not values or any(v is None for v in values):
        return None
    x = np.floor(np.asarray(values, np.float64) * SCALE)
    raw = np.asarray(values, np.float64)
    if not np.isfinite(raw).all():
        return None
    if np.isfinite(x).all() and np.abs(x).max() < 2**62:
        return x.astype(np.int64)
    return np.array([int(v * SCALE) if abs(v) > 2**60 else int(np.floor(v * SCALE)) for v in map(float, raw)], object)


def packed(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(n, ids, width, item, cells, exact): rows of vectors in blocks; exact holds integers of `item` bytes, as few as hold
    the block's values, or (item 0) decimal text of values beyond 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i is not None and v is not None and (x := integers(v)) is not None:
                    ids.append(i)
                    rows.append(x)
            for a in range(0, len(ids), BLOCK):
                part = rows[a : a + BLOCK]
                width = max(map(len, part))
                wide = any(x.dtype == object for x in part)
                m = np.zeros((len(part), width), object if wide else np.int64)
                for r, x in enumerate(part):
                    m[r, : len(x)] = x
                kind = None if wide else next(t for t in map(np.dtype, ("i1", "i2", "i4", "i8")) if np.iinfo(t).min <= m.min() and m.max() <= np.iinfo(t).max)
                exact = ",".join(map(str, m.ravel())).encode() if wide else m.astype(kind).tobytes()
                yield pa.RecordBatch.from_pydict({"n": [len(part)], "ids": [np.array(ids[a : a + BLOCK], np.int64).tobytes()], "width": [width], "item": [0 if wide else kind.itemsize], "cells": [cells(m)], "exact": [exact]}, schema=pa.schema([("n", pa.int64()), ("ids", pa.binary()), ("width", pa.int32()), ("item", pa.int32()), ("cells", pa.binary()), ("exact", pa.binary())]))

    return vectors.select(F.col(id_col).cast("long"), F.col(vec_col)).mapInArrow(run, "n long, ids binary, width int, item int, cells binary, exact binary")


def cells(m: np.ndarray) -> bytes:
    """Per dimension the grid's low edge and step (float64), then 4-bit codes, two to a byte."""
    f = m.astype(np.float64)
    low = f.min(0)
    step = np.maximum((f.max(0) - low) / CELLS, np.finfo(np.float64).tiny)
    code = np.minimum(np.floor((f - low) / step), CELLS - 1).astype(np.uint8)
    if code.shape[1] % 2:
        code = np.hstack([code, np.zeros((len(code), 1), np.uint8)])
    return low.tobytes() + step.tobytes() + (code[:, ::2] << 4 | code[:, 1::2]).tobytes()


def cell_edges(data: bytes, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's cell: low and high corner, widened by what rounding can move."""
    low, step = np.frombuffer(data, np.float64, width), np.frombuffer(data, np.float64, width, 8 * width)
    pairs = np.frombuffer(data, np.uint8, offset=16 * width).reshape(n, -1)
    code = np.stack([pairs >> 4, pairs & 15], 2).reshape(n, -1)[:, :width]
    slack = 1e-9 * (np.abs(low) + CELLS * step)
    return low + code * step - slack, low + (code + 1.0) * step + slack


def exact_matrix(data: bytes, n: int, width: int, item: int) -> np.ndarray:
    if not item:
        return np.array([int(x) for x in data.split(b",")], object).reshape(n, width)
    return np.frombuffer(data, f"i{item}").astype(np.int64).reshape(n, width)


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.hstack([m, np.zeros((len(m), width - m.shape[1]), m.dtype)])


def search(q_ids: np.ndarray, q: np.ndarray, v_ids: np.ndarray, low: np.ndarray, high: np.ndarray, v: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, list]]:
    """Per query: its id, the ids of its k best vectors and their scores."""
    big = q.dtype == object or v.dtype == object or float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] >= 2**52
    exact = v.astype(object) if big else v.astype(np.float64)
    ask = q.astype(object) if big else q.astype(np.float64)
    for a in range(0, len(q), 256):
        f = q[a : a + 256].astype(np.float64)
        bound = np.maximum(f, 0) @ high.T + np.minimum(f, 0) @ low.T
        bound += 1e-9 * (np.abs(f) @ np.maximum(np.abs(high), np.abs(low)).T)
        for row in range(len(f)):
            own = v_ids != q_ids[a + row]
            order = np.argsort(-bound[row], kind="stable")
            order = order[own[order]]
            ids, scores, at, take = np.zeros(0, np.int64), np.zeros(0, exact.dtype), 0, 4 * k
            while at < len(order) and (len(ids) < k or bound[row, order[at]] >= float(scores[k - 1])):
                read = order[at : at + take]
                at, take = at + take, 2 * take
                ids, scores = np.concatenate([ids, v_ids[read]]), np.concatenate([scores, exact[read] @ ask[a + row]])
                best = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k] if big else np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            yield int(q_ids[a + row]), ids, [int(s) for s in scores]


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other vectors."""
    blocks = written(packed(vectors, id_col, vec_col))
    asked = written(packed(queries, id_col, vec_col).drop("cells"))
    sizes = [df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for df in (blocks, asked)]
    v_groups, q_groups = (max(1, -(-n // per)) for n, per in zip(sizes, (GROUP_VECTORS, GROUP_QUERIES), strict=True))
    deal = lambda df, n: F.pmod(F.xxhash64("ids"), F.lit(n)).cast("int")
    left = asked.withColumn("qg", deal(asked, q_groups)).withColumn("vg", F.explode(F.sequence(F.lit(0), F.lit(v_groups - 1))))
    right = blocks.withColumn("vg", deal(blocks, v_groups)).withColumn("qg", F.explode(F.sequence(F.lit(0), F.lit(q_groups - 1))))

    def run(asks: pa.Table, held: pa.Table) -> pa.Table:
        out: list[tuple[int, int, str]] = []
        if asks.num_rows and held.num_rows:
            width = max(max(asks.column("width").to_pylist()), max(held.column("width").to_pylist()))
            v, low, high, v_ids = [], [], [], []
            for r in held.to_pylist():
                v.append(widened(exact_matrix(r["exact"], r["n"], r["width"], r["item"]), width))
                lo, hi = cell_edges(r["cells"], r["n"], r["width"])
                low.append(widened(lo, width))
                high.append(widened(hi, width))
                v_ids.append(np.frombuffer(r["ids"], np.int64))
            v, low, high, v_ids = (np.concatenate(x) for x in (v, low, high, v_ids))
            for r in asks.to_pylist():
                q = widened(exact_matrix(r["exact"], r["n"], r["width"], r["item"]), width)
                for i, ids, scores in search(np.frombuffer(r["ids"], np.int64), q, v_ids, low, high, v, k):
                    out += [(i, int(j), s) for j, s in zip(ids, scores, strict=True)]
        cut = lambda s: max(-(2**63), min(2**63 - 1, s))
        a, b, c = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array([cut(s) for s in c], pa.int64()), "order": pa.array([float(s) for s in c], pa.float64())})

    near = left.groupBy("qg", "vg").cogroup(right.groupBy("qg", "vg")).applyInArrow(run, "query_id long, vec_id long, score long, order double")
    best = Window.partitionBy("query_id").orderBy(F.desc("order"), F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20
"""
