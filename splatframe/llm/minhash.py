"""Near-duplicate documents: fast similarity sketching, banding, and verification on the full shingle sets.

Sketch (Dahlgaard, Knudsen and Thorup, 2017): in rounds 0..t-1 every element is thrown into a hashed bin, in rounds
t..2t-1 into bin round - t; a bin keeps the least (round, hash) it gets, so every coordinate fills, usually within a few
rounds, and the share of equal coordinates is concentrated about the Jaccard similarity. The coordinates are cut
into bands; documents that share a band are candidates. At similarity 0.8 a pair shares none of the 56 bands of 6
with probability 4.0e-8.

Documents with equal sets are one class from the start. Classes in one band are not paired with each other
wholesale: in a few star rounds each class meets one candidate of another component, links found join components, and
only classes of one band that are still in different components are then paired (in large bands only where their
prefixes in the order of rising shingle frequency meet, and their other shingles are enough for a link). So a group that hangs together costs pairs in
proportion to its size. Every link counts only after comparing the full sets of both texts.

Words are runs of anything but space and bytes 9-13, A-Z lowered. With fewer words than a shingle has, the whole
sequence is the one shingle; null, empty and blank texts have none and are linked with nothing. Rows that share an id
are one node. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from splatframe.llm.common import components, grouped, pack_ints, pack_sorted, shard_of, splitmix, table, text_bytes, trim, unpack_ints, unpack_sorted, with_row_key, written

WORDS, PERCENT = 5, 80
BANDS, ROWS = 56, 6
STAR_ROUNDS = 2
#: Nodes of a band that are paired outright, and nodes that a rare shingle has at most; either way no link is lost.
FEW, RARE = 32, 8
#: Band keys of one shard.
BAND_KEYS = 1 << 20
#: Hash parts by which the bound on what two sets share is summed.
PARTS = 64
_ROUNDS = splitmix(np.arange(2 * BANDS * ROWS, dtype=np.uint64) + np.uint64(1))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    found = text_bytes(text).lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    size = min(words, len(found))
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    acc = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        acc = splitmix(acc ^ w[k : len(w) - size + 1 + k])
    return np.unique(acc)


def sketch(elements: np.ndarray, t: int) -> np.ndarray:
    """t coordinates of a non-empty set."""
    out, full = np.zeros(t, np.uint64), np.zeros(t, bool)
    rounds, at, n = (_ROUNDS if t == BANDS * ROWS else splitmix(np.arange(2 * t, dtype=np.uint64) + np.uint64(1))), 0, len(elements)
    take = max(1, min(2 * t, int(t * (np.log(t) + 1) / n) + 1))
    while not full.all():
        seeds = rounds[at : at + take]
        v = np.sort(splitmix(elements[None, :] ^ seeds[:, None]), axis=1)
        bins = ((v >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        late = np.arange(at, at + len(seeds)) >= t
        bins[late] = (np.arange(at, at + len(seeds), dtype=np.uint64)[late] - np.uint64(t))[:, None]
        where, first = np.unique(bins.ravel(), return_index=True)
        new = ~full[where]
        out[where[new]] = v.ravel()[first[new]] ^ seeds[first[new] // n]
        full[where] = True
        at, take = at + take, max(1, take // 4)
    return out


def bands(elements: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    s = sketch(elements, n_bands * rows).reshape(n_bands, rows)
    acc = np.arange(n_bands, dtype=np.uint64)
    for k in range(rows):
        acc = splitmix(acc ^ s[:, k])
    return acc


def features(docs: DataFrame, words: int, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands): set_a and set_b identify the set in 128 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, keys = [], [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), words)
                digest = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
                n.append(len(s))
                a.append(int(digest[0]))
                b.append(int(digest[1]))
                keys.append(bands(s, n_bands, rows).view(np.int64) if len(s) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_a", "set_b", "bands"])
        trim()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def zipped(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([zstandard.compress(text_bytes(t.as_py()), 3) for t in batch.column(1)], pa.binary())], ["node", "z"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "node long, z binary")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int = PERCENT) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar enough; texts: (node, z)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @functools.lru_cache(16)  # bounds memory by so many of the longest texts' sets
        def full(z: bytes) -> np.ndarray:
            return shingle_set(zstandard.decompress(z).decode(), words)

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("za"), batch.column("zb"), strict=True):
                p, q = full(x.as_py()), full(y.as_py())
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(len(p) > 0 and 100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        full.cache_clear()
        trim()

    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("z").alias("zb")), "b")
    return with_b.join(texts.select(F.col("node").alias("a"), F.col("z").alias("za")), "a").mapInArrow(run, "a long, b long")


def shingle_rows(texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, shingle) of the given nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, z in zip(batch.column("node").to_pylist(), batch.column("z"), strict=True):
                s = shingle_set(zstandard.decompress(z.as_py()).decode(), words)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), node)), pa.array(s.view(np.int64))], ["node", "shingle"])

    return texts.join(nodes, "node", "left_semi").select("node", "z").mapInArrow(run, "node long, shingle long")


def last_pairs(rows: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): every pair in one band but different components that can be a link; rows: (key, node, n, component).

    Bands of few nodes pair all of them. In large ones shingles are ordered by the number of these nodes that have
    them: two similar sets then share one of their first n - ceil(percent * n / 100) + 1 (prefix filter). Either it is
    one that at most RARE nodes have, by which they are found; or both have so few of those that their prefixes go
    beyond them, and only such nodes are paired, where their prefixes meet and the sum over hash parts of the smaller
    of their numbers of other shingles is enough for a link. Such a pair is made in the least of these bands that it shares.
    """
    fits = lambda n, m: 100 * F.least(n, m) >= percent * F.greatest(n, m)
    rows = written(rows.join(rows.groupBy("key").agg(F.count("*").alias("in_key")), "key"))
    many = rows.filter(F.col("in_key") > FEW).drop("in_key")
    nodes = written(many.groupBy("node", "n", "component").agg(F.sort_array(F.collect_set("key")).alias("keys")))  # BANDS keys at most
    apart = F.col("component") < F.col("component_b")
    once = F.col("key") == F.array_min(F.array_intersect("keys", "keys_b"))
    few = rows.filter(F.col("in_key") <= FEW).drop("in_key")
    pairs = few.join(right_of(few, "key"), "key").filter(apart & fits(F.col("n"), F.col("n_b"))).select("node", "node_b")
    each = written(shingle_rows(texts, nodes.select("node").distinct(), words))
    counted = each.join(each.groupBy("shingle").count(), "shingle").join(nodes.select("node", "n", "component"), "node")
    prefix = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
    first = F.row_number().over(Window.partitionBy("node", "component").orderBy("count", "shingle"))
    placed = written(counted.withColumn("first", first <= prefix))
    rarely = placed.filter(F.col("first") & (F.col("count") <= RARE)).select("shingle", "node", "n", "component")
    shared = rarely.join(right_of(rarely, "shingle"), "shingle").filter(apart & fits(F.col("n"), F.col("n_b"))).select("node", "node_b")
    # all rare shingles of the nodes below are in their prefixes: two that share one are found already
    part, common = F.pmod(F.col("shingle"), F.lit(PARTS)), placed.filter(F.col("count") > RARE)
    heavy = common.groupBy("node", "n", "component").agg(F.array(*[F.count_if(part == k) for k in range(PARTS)]).alias("caps"), F.count("*").alias("common"), F.collect_list(F.when(F.col("first"), F.col("shingle"))).alias("prefix"))
    heavy = written(heavy.filter(F.col("n") - F.col("common") < prefix).join(nodes.select("node", "component", "keys"), ["node", "component"]).drop("common"))
    capped = many.select("key", "node", "component").join(heavy, ["node", "component"])
    most = F.aggregate(F.zip_with("caps", "caps_b", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda a, x: a + x)
    enough = F.arrays_overlap("prefix", "prefix_b") & ((100 + percent) * most >= percent * (F.col("n") + F.col("n_b")))
    pairs = pairs.union(capped.join(right_of(capped, "key"), "key").filter(apart & fits(F.col("n"), F.col("n_b")) & enough & once).select("node", "node_b"))
    return pairs.union(shared).distinct().toDF("a", "b")


def right_of(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[F.col(c).alias(f"{c}_b") for c in df.columns if c != key])


def shared_bands(base: DataFrame, n_bands: int) -> DataFrame:
    """(key, node, n) of the bands that more than one row has; base: features() as written, so that it is read twice alike.

    Most bands are in one row only, so they are not rows of a join: each batch sends its keys, nodes and sizes as packed
    arrays to shards of the keys, once. Of a key that more rows of a batch have only two are sent, as the others are
    known to share it; so a key that a large group has doesn't fill a shard.
    """
    rows = base.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "bands")
    shards = max(16, rows.count() * n_bands // BAND_KEYS + 1)

    def sorted_keys(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
        """Keys, nodes and sizes by key; and which are sent."""
        lists = batch.column("bands")
        keys, per = np.asarray(lists.flatten()).view(np.uint64), np.asarray(pa.compute.list_value_length(lists))
        order = np.argsort(keys, kind="stable")
        key = keys[order]
        sent = np.ones(len(key), bool)
        sent[2:] = key[2:] != key[:-2]
        return [key, *(np.repeat(np.asarray(batch.column(c)), per)[order] for c in ("doc_id", "n_shingles"))], sent

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, sent = sorted_keys(batch)
            k, node, n = (c[sent] for c in columns)
            of = shard_of(k, shards)
            begin = np.flatnonzero(np.diff(of, prepend=np.uint64(shards + 1)))
            cuts = list(zip(begin, np.append(begin[1:], len(k)), strict=True)) if len(k) else []
            packed = {name: pa.array([pack(c[a:b]) for a, b in cuts], pa.binary()) for name, c, pack in (("keys", k, pack_sorted), ("nodes", node, pack_ints), ("sizes", n, pack_ints))}
            yield pa.RecordBatch.from_pydict({"shard": pa.array(of[begin].astype(np.int64)), **packed})
        trim()

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, sent = sorted_keys(batch)
            yield pa.RecordBatch.from_pydict({name: pa.array(c[~sent].view(np.int64)) for name, c in zip(("key", "node", "n"), columns, strict=True)})

    def meet(group: pa.Table) -> pa.Table:
        k, node, n = (np.concatenate([unpack(x) for x in group.column(c).to_pylist()]) for c, unpack in (("keys", unpack_sorted), ("nodes", unpack_ints), ("sizes", unpack_ints)))
        _, _, inverse, counts = grouped(k)
        keep = counts[inverse] > 1
        out = pa.table({name: pa.array(c[keep].view(np.int64)) for name, c in (("key", k), ("node", node), ("n", n))})
        trim()
        return out

    met = rows.mapInArrow(send, "shard long, keys binary, nodes binary, sizes binary").groupBy("shard").applyInArrow(meet, "key long, node long, n long")
    return met.unionByName(rows.mapInArrow(others, "key long, node long, n long"))


def near_links(docs: DataFrame, words: int, percent: int = PERCENT, n_bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node) of every row, node being the smallest id with the same set (null without
    shingles); and (node, component) of the nodes that have a link to another."""
    base = written(features(docs, words, n_bands, rows))
    classes = base.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"))
    members = written(base.select("doc_id", "n_shingles", "set_a", "set_b").join(classes, ["set_a", "set_b"], "left").drop("set_a", "set_b"))
    near = written(shared_bands(base, n_bands).join(members.filter("doc_id = node").select("node").distinct(), "node", "left_semi"))
    crowd = near.groupBy("key").agg(F.count("*").alias("crowd")).filter("crowd > 1")  # of bands that only copies share, one node is left
    near = written(near.join(crowd, "key"))
    texts = written(zipped(docs.join(near.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")))
    fits = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    links = joined = tested = None
    # rows that share an id but not the set: a node of several classes needs no link of its own
    weight = near.groupBy("node").agg(F.sum("crowd").alias("weight"))  # central documents share most
    near = written(near.drop("crowd").join(weight, "node"))
    for star in range(STAR_ROUNDS + 1):
        rows_ = near.withColumn("component", F.col("node")) if joined is None else near.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
        split = rows_.groupBy("key").agg(F.max(F.struct("weight", "node", "n", "component")).alias("head"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
        if star < STAR_ROUNDS:
            met = rows_.join(split, "key").filter("component <> head.component").select(F.col("node").alias("a"), F.col("head.node").alias("b"), "n", F.col("head.n").alias("m")).filter(fits)
            votes = met.groupBy("a", "b").count()
            if tested is not None:
                votes = votes.join(tested, ["a", "b"], "left_anti")
            pairs = votes.groupBy("a").agg(F.max(F.struct("count", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
        else:
            pairs = last_pairs(rows_.join(split.select("key"), "key").select("key", "node", "n", "component").distinct(), texts, words, percent)
            pairs = pairs.join(tested.select("a", "b").union(tested.select("b", "a")), ["a", "b"], "left_anti")
        pairs = written(pairs)
        found = written(verified(pairs, texts, words, percent))
        tested = pairs if tested is None else tested.union(pairs)
        links = found if links is None else links.union(found)
        joined = components(links)
    return members, joined


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    members, joined = near_links(docs, words, percent)
    out = members.join(joined, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component, that of the smallest doc_id; repeated rows are rows like others."""
    keyed, key = with_row_key(docs)
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), words, percent).select(F.col("doc_id").alias(key), "component_id")
    found = written(found.join(keyed.select(key, F.col("doc_id").cast("long").alias("id")), key))
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", key))[key].alias(key))
    gone = written(found.select(key).join(first, key, "left_anti"))  # its size is known then: texts are shuffled only where ids are too many to broadcast
    return keyed.join(gone, key, "left_anti").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


def _oracle(words: int) -> str:
    """Every pair of documents that share a shingle, for small tables."""
    grams = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - {words} + 2), lambda i: {grams})) END AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n) GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * c >= {PERCENT} * (na + nb - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, u.b FROM r JOIN u ON r.other = u.a),
m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept FROM s JOIN m USING (doc_id)
"""


ORACLE_SQL = _oracle(2)
