"""Stupid-backoff scores of every document against the n-gram counts of all others.

Count tables hold every n-gram of the corpus up to ORDER words, partitioned by hash. Documents are read in blocks; a
block's n-grams are exploded, counted and sent once each to the partition of their hash, joined there to the counts
over all blocks, and come back to be summed per document. A document's own occurrences are taken off (leave-one-out),
so its score says how well the rest of the corpus predicts it:

    S(w | u, v) = c(u v w) / c(u v) if c(u v w) > 0, else ALPHA * S(w | v); S(w) = c(w) / N; an unseen word counts 1/2.

Words are runs of anything but space and bytes 9-13, A-Z lowered; n-grams don't cross documents. N-grams are known by
hashes of as many bits as leave an n-gram a chance of 2^-SLACK, at any size of the input, to share one with another (64
at most). Null, empty and blank texts have no words and a null score. Rows are documents of their own even if
ids or texts repeat. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splatframe.llm.common import Blocks, answered, ask, grouped, shards_for, splitmix, steady, table, text_bytes, text_total, totals

ORDER, ALPHA = 3, 0.4
UNSEEN = 0.5
BLOCK_BYTES = 6 << 20
SLACK = 28
#: The key under which the number of words is counted.
ALL = np.uint64(0x5851F42D4C957F2D)


def key_mask(n_keys: float) -> np.uint64:
    return np.uint64(2**64 - 2 ** (64 - min(64, max(1, int(n_keys)).bit_length() + SLACK)))


def grams(texts: list[str | None], order: int, mask: np.uint64) -> tuple[np.ndarray, list[np.ndarray]]:
    """Each word's document, and per length n the key of the n-gram that ends at the word (0: none)."""
    hashed = [np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) for words in (text_bytes(t).lower().split() for t in texts)]
    sizes = np.array([len(h) for h in hashed], np.int64)
    w = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(hashed)), sizes)
    place = np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = []
    for n in range(1, order + 1):
        key = np.full(len(w), n, np.uint64)
        for k in range(n - 1, -1, -1):
            key[n - 1 :] = splitmix(key[n - 1 :] ^ w[n - 1 - k : len(w) - k])
        key &= mask
        key[place < n - 1] = 0
        out.append(key)
    return doc, out


class Block:
    """A block's n-grams: sorted distinct keys (with the one for the number of words), their counts, and for each
    word and length the place of its n-gram among the keys (-1: none)."""

    def __init__(self, texts: list[str | None], order: int, mask: np.uint64) -> None:
        self.size = len(texts)
        self.doc, keys = grams(texts, order, mask)
        n_words, flat = len(keys[0]), np.concatenate(keys)
        del keys
        there = flat != 0
        uniq, _, inverse, counts = grouped(flat[there])
        all_at = int(np.searchsorted(uniq, ALL))
        self.keys, self.counts, self.all_at = np.insert(uniq, all_at, ALL), np.insert(counts, all_at, n_words), all_at
        at = np.full(len(flat), -1, np.int32 if len(flat) < 2**31 - 2 else np.int64)
        at[there] = inverse + (inverse >= all_at)
        self.at = at.reshape(order, -1)

    def scores(self, total: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
        """Number of words and sum of log scores of each text; total: the corpus's counts of the keys."""
        words = np.bincount(self.doc, minlength=self.size)
        if not len(self.doc):
            return words, np.zeros(self.size)
        rest = []  # counts in other documents, by length
        for at in self.at:
            _, _, inverse, own = grouped(splitmix((self.doc * (len(self.keys) + 1) + at).astype(np.uint64)))
            rest.append(np.where(at >= 0, total[at].astype(np.float64) - own[inverse], 0.0))
        one = rest[0]
        log = np.log(np.where(one > 0, one, UNSEEN) / np.maximum(float(total[self.all_at]) - words[self.doc], 1.0))
        for n in range(2, len(rest) + 1):
            seen, there = rest[n - 1] > 0, self.at[n - 1] >= 0
            context = np.concatenate([[0.0], rest[n - 2][:-1]])
            log = np.where(seen, np.log(np.where(seen, rest[n - 1], 1.0) / np.where(seen, context, 1.0)), np.where(there, np.log(alpha) + log, log))
        return words, np.bincount(self.doc, log, self.size)


def backoff_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA) -> DataFrame:
    """(doc_id, n_words, log_score): sums over each document's words; log_score is null without words."""

    docs = steady(docs.select(F.col("doc_id").cast("long"), "text"))
    n_bytes = text_total(docs)
    shards, mask = shards_for(n_bytes, 0.15 * order), key_mask(n_bytes / 2 * order)  # words have two bytes or more

    def keys_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        b = Block(rows.column("text").to_pylist(), order, mask)
        return b.keys, b.counts

    def use(rows: pa.Table, total: np.ndarray, block: str) -> pa.Table:
        words, log = Block(rows.column("text").to_pylist(), order, mask).scores(total >> np.uint64(1), alpha)
        return pa.table({"doc_id": rows.column("doc_id"), "n_words": pa.array(words, pa.int64()), "log_score": pa.array(log, mask=words == 0)})

    blocks = Blocks(docs, BLOCK_BYTES)
    counts = totals(ask(blocks, keys_of, shards), shards, n_bytes // BLOCK_BYTES + 1)
    return answered(blocks, counts, use, "doc_id long, n_words long, log_score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backoff_scores(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round(F.col("log_score") / F.col("n_words"), 6).alias("mean_log_score"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
t AS (SELECT doc_id, i, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS b, CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS c,
  CASE WHEN i > 1 THEN w[i - 1] END AS pa, CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] END AS pb FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
own AS (SELECT doc_id, g, count(*) AS n FROM (SELECT doc_id, unnest([a, b, c]) AS g FROM t) WHERE g IS NOT NULL GROUP BY 1, 2),
every AS (SELECT g, sum(n) AS n FROM own GROUP BY 1),
rest AS (SELECT doc_id, g, CAST(every.n - own.n AS DOUBLE) AS n FROM own JOIN every USING (g)),
sizes AS (SELECT doc_id, len(w) AS n, sum(len(w)) OVER () AS total FROM d),
j AS (SELECT t.doc_id, t.b, t.c, ra.n AS na, rb.n AS nb, rc.n AS nc, rpa.n AS npa, rpb.n AS npb, greatest(total - sizes.n, 1) AS m FROM t JOIN sizes USING (doc_id)
  JOIN rest ra ON ra.doc_id = t.doc_id AND ra.g = t.a LEFT JOIN rest rb ON rb.doc_id = t.doc_id AND rb.g = t.b LEFT JOIN rest rc ON rc.doc_id = t.doc_id AND rc.g = t.c
  LEFT JOIN rest rpa ON rpa.doc_id = t.doc_id AND rpa.g = t.pa LEFT JOIN rest rpb ON rpb.doc_id = t.doc_id AND rpb.g = t.pb),
k AS (SELECT doc_id, CASE WHEN nc > 0 THEN ln(nc / npb) WHEN nb > 0 THEN ln(nb / npa) + CASE WHEN c IS NOT NULL THEN ln(0.4) ELSE 0 END
  ELSE ln(CASE WHEN na > 0 THEN na ELSE 0.5 END / m) + CASE WHEN c IS NOT NULL THEN 2 * ln(0.4) WHEN b IS NOT NULL THEN ln(0.4) ELSE 0 END END AS s FROM j)
SELECT sizes.doc_id, CAST(any_value(sizes.n) AS BIGINT) AS n_words, round(sum(k.s) / any_value(sizes.n), 6) AS mean_log_score FROM sizes LEFT JOIN k USING (doc_id) GROUP BY 1
"""
