"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text, and thresholds by language.

The model is one of characters (code points, digits as 0), of ORDER of them. Each language has two, fitted crosswise:
documents fall into two folds by the hash of their ids, every labelled trusted document trains the model of its fold,
and every document is scored by the model of the other fold. So all trusted documents train, and all are held out for
the thresholds. Counts, continuation
counts and discounts are group-bys and joins; the result is a table of n-grams with the discounted share of each
(as an n-gram) and its backoff weight (as a context), partitioned by hash. Blocks of documents send their distinct
n-grams to these shards, get both numbers back, and sum log probabilities per document over whole texts.

A document is rejected where its mean negative log probability, less SHORT / sqrt(characters) as short texts scatter,
is above its language's threshold: the QUANTILE of that number over all of the language's trusted documents, plus
MARGIN nats.
Languages with fewer than LEAST trusted documents (and null) share the models and threshold of all languages together,
which are made likewise from all trusted documents, scored by those models.

Null and empty texts have no score and are kept, since nothing speaks against them; so is everything where no
document is labelled. Rows are scored one by one, so repeated rows get equal results. An empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from splatframe.llm.common import Blocks, answered, ask, grouped, shard_of, splitmix, steady, table, text_total, trim, unpack_sorted, written

ORDER, ALPHABET = 4, 4096
LEAST = 40
QUANTILE, MARGIN, SHORT = 0.995, 0.1, 4.0
EVERY = "*"
PAD = "\x02"
BLOCK_BYTES = 3 << 20
#: Distinct n-grams that a worker counts before it hands them on to be summed, and characters it counts at once.
COUNTED, COUNTED_CHARS = 1 << 18, 1 << 20
#: Ids of trusted documents that are broadcast to their texts; beyond, texts are shuffled once to meet them.
BROADCAST_IDS = 6 << 20
#: N-grams of the model in one shard, and bytes of text that ask one copy of it.
SHARD_GRAMS, SALT_BYTES = 1 << 18, 4 << 30
DIGITS = re.compile(r"[0-9]")
STEP = np.uint64(0x100000001B3)
#: Keys have 56 bits: with 2^21 n-grams in the models, another one meets one of their keys with probability 2^-35.
KEY_BITS = ~np.uint64(0xFF)


def plain(text: str) -> str:
    return DIGITS.sub("0", text)


def seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def keys_at(points: np.ndarray, seeds: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Key of the n-gram that ends before position ends."""
    acc = seeds + np.uint64(n)
    for k in range(n, 0, -1):
        acc = splitmix(acc ^ points[ends - k])
    return (splitmix(acc) if n == 0 else acc) & KEY_BITS


def discounts(row) -> list[float]:
    """D1, D2 and D3+ from the numbers of n-grams seen once to four times."""
    n = [row[f"n{k}"] for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    return [min(k - 0.01, max(0.05, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] and n[k] else k / 2 for k in (1, 2, 3)]


def gram_counts(texts: DataFrame, order: int = ORDER, counted: int = COUNTED, at_once: int = COUNTED_CHARS) -> DataFrame:
    """(lang, gram, c) from (lang, text): occurrences of all ORDER-grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = None
            langs = sorted(set(batch.column("lang").to_pylist()))
            place = {lang: i for i, lang in enumerate(langs)}
            ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.utf8_length(batch.column("text")), 0)))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + at_once, "right")))
                g = Grams(batch.slice(at, to - at), frozenset(langs), order)
                code = g.codes, g.counts, g.points[g.ends[:, None] + np.arange(-order, 0)], np.array([place[x] for x in g.langs], np.int32)[g.doc]
                found, at = (code if found is None else [np.concatenate(x) for x in zip(found, code, strict=True)]), to
                if len(found[0]) > counted:
                    found = added(*found)
                    if len(found[0]) > counted // 2:
                        yield out(langs, *found)
                        found = None
            if found is not None:
                yield out(langs, *added(*found))
        trim()

    def added(codes: np.ndarray, counts: np.ndarray, chars: np.ndarray, of: np.ndarray) -> list[np.ndarray]:
        uniq, first, inverse, _ = grouped(codes)
        return [uniq, np.bincount(inverse, counts, len(uniq)).astype(np.int64), chars[first], of[first]]

    def out(langs: list[str], codes: np.ndarray, counts: np.ndarray, chars: np.ndarray, of: np.ndarray) -> pa.RecordBatch:
        joined = np.ascontiguousarray(chars, "<u4").tobytes().decode("utf-32-le")
        grams = [joined[i : i + order] for i in range(0, len(joined), order)]
        return pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()).take(pa.array(of)), "gram": pa.array(grams, pa.string()), "c": pa.array(counts)})

    return texts.select("lang", "text").mapInArrow(count, "lang string, gram string, c long").groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def model(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, direct, gamma) from (lang, text): each n-gram's discounted share and its weight as a context."""
    return model_of(written(gram_counts(texts, order)), order)


def model_of(level: DataFrame, order: int = ORDER) -> DataFrame:
    """model() from what gram_counts() found."""
    direct = gamma = None
    for n in range(order, 0, -1):
        of = {r["lang"]: discounts(r) for r in level.groupBy("lang").agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in range(1, 5)]).collect()}  # a row per language
        pick = lambda k, of=of: F.create_map(*[F.lit(x) for lang, d in of.items() for x in (lang, d[k])])[F.col("lang")] if of else F.lit(0.5)
        context = F.substring("gram", 1, n - 1) if n > 1 else F.lit("")
        level = level.withColumn("context", context)
        sums = level.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count_if(F.col("c") == 1).alias("m1"), F.count_if(F.col("c") == 2).alias("m2"), F.count_if(F.col("c") > 2).alias("m3"))
        sums = sums.select("lang", "context", "total", ((pick(0) * F.col("m1") + pick(1) * F.col("m2") + pick(2) * F.col("m3")) / F.col("total")).alias("gamma"))
        cut: Column = F.when(F.col("c") == 1, pick(0)).when(F.col("c") == 2, pick(1)).otherwise(pick(2))
        some = level.join(sums, ["lang", "context"]).select("lang", "gram", ((F.col("c") - cut) / F.col("total")).alias("direct"))
        direct = some if direct is None else direct.union(some)
        weights = sums.select("lang", F.col("context").alias("gram"), "gamma")
        gamma = weights if gamma is None else gamma.union(weights)
        if n > 1:  # how many different characters precede each shorter n-gram
            level = level.select("lang", F.substring("gram", 2, n - 1).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("c"))
    both = direct.join(gamma, ["lang", "gram"], "full")
    return both.select("lang", "gram", F.coalesce("direct", F.lit(0.0)).alias("direct"), F.coalesce("gamma", F.lit(1.0)).alias("gamma"))


class Grams:
    """A block's texts as code points, with the distinct (language, ORDER-gram) pairs of its positions."""

    def __init__(self, rows: pa.Table, known: frozenset[str], order: int) -> None:
        self.order = order
        texts = [PAD * (order - 1) + plain(t or "") for t in rows.column("text").to_pylist()]
        self.langs = rows.column("lang").to_pylist()
        self.points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.chars = sizes - (order - 1)
        seeds = np.array([seed(x if x in known else EVERY) for x in self.langs], np.uint64)
        begin = np.cumsum(sizes) - sizes
        ends = np.concatenate([np.arange(b + order, b + s + 1, dtype=np.int32) for b, s in zip(begin, sizes, strict=True)]) if len(sizes) else np.zeros(0, np.int32)
        code = np.repeat(splitmix(seeds), self.chars)
        for k in range(order, 0, -1):
            code *= STEP
            code += self.points[ends - k]
        del texts
        code = splitmix(code)
        self.codes, first, self.inverse, self.counts = grouped(code)
        del code
        self.ends, self.doc = ends[first], np.repeat(np.arange(len(sizes), dtype=np.int32), self.chars)[first]
        self.seeds = seeds[self.doc]

    def levels(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Keys of the n-grams of 1..order characters, and of the contexts of 0..order-1, of the distinct pairs."""
        return [keys_at(self.points, self.seeds, self.ends, n) for n in range(1, self.order + 1)], [keys_at(self.points, self.seeds, self.ends - 1, n) for n in range(self.order)]

    def keys(self) -> np.ndarray:
        a, b = self.levels()
        return np.unique(np.concatenate([*a, *b]))

    def scores(self, keys: np.ndarray, direct: np.ndarray, gamma: np.ndarray) -> np.ndarray:
        """Sum of negative log probabilities of each text."""
        grams, contexts = self.levels()
        p = np.full(len(self.ends), 1.0 / ALPHABET)
        for g, c in zip(grams, contexts, strict=True):
            p = direct[np.searchsorted(keys, g)] + gamma[np.searchsorted(keys, c)] * p
        doc = np.repeat(np.arange(len(self.chars), dtype=np.int32), self.chars)
        return np.bincount(doc, -np.log(np.maximum(p, 1e-300))[self.inverse], len(self.chars))


def pack_floats(x: np.ndarray) -> bytes:
    """float32 as byte planes, as signs and exponents are much alike."""
    return zstandard.compress(np.ascontiguousarray(x.astype(np.float32).view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def unpack_floats(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.float32).ravel()


def gram_keys(langs: list[str], grams: list[str]) -> np.ndarray:
    """Keys of n-grams of any length, as keys_at() has them for places in texts."""
    points = np.frombuffer("".join(grams).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.array([len(g) for g in grams], np.int64)
    ends, seeds, out = np.cumsum(sizes), np.array([seed(x) for x in langs], np.uint64), np.zeros(len(grams), np.uint64)
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        out[at] = keys_at(points, seeds[at], ends[at], int(n))
    return out


def looked_up(asked: DataFrame, weights: DataFrame, shards: int, salts: int) -> DataFrame:
    """(block, shard, totals): for each block's keys both numbers of the model, joined shard by shard.

    The model doesn't grow with docs but what they ask does, so blocks are dealt by salt and each salt has a copy of
    every shard.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = gram_keys(batch.column("lang").to_pylist(), batch.column("gram").to_pylist())
            yield pa.RecordBatch.from_pydict({"shard": pa.array(shard_of(k, shards).astype(np.int64)), "key": pa.array(k.view(np.int64)), "direct": batch.column("direct"), "gamma": batch.column("gamma")})

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        key = right.column("key").to_numpy().view(np.uint64) if right.num_rows else np.zeros(0, np.uint64)
        order = np.argsort(key)
        key = np.append(key[order], np.uint64(2**64 - 1))
        d, g = (np.append(right.column(c).to_numpy()[order] if right.num_rows else np.zeros(0), x) for c, x in (("direct", 0.0), ("gamma", 1.0)))
        out = []
        for data in left.column("keys").to_pylist():
            ask_ = unpack_sorted(data)
            at = np.minimum(np.searchsorted(key, ask_), len(key) - 1)
            hit = key[at] == ask_
            out.append(pack_floats(np.concatenate([np.where(hit, d[at], 0.0), np.where(hit, g[at], 1.0)])))
        return pa.table({"block": left.column("block") if left.num_rows else pa.array([], pa.string()), "shard": left.column("shard") if left.num_rows else pa.array([], pa.int64()), "totals": pa.array(out, pa.binary())})

    table_ = weights.mapInArrow(keyed, "shard long, key long, direct double, gamma double").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = asked.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    return dealt.groupBy("shard", "salt").cogroup(table_.groupBy("shard", "salt")).applyInArrow(run, "block string, shard long, totals binary")


def unpack_pairs(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    halves = [unpack_floats(x).reshape(2, -1) for x in parts]
    both = np.concatenate(halves, axis=1).astype(np.float64) if halves else np.zeros((2, 0))
    return both[0], both[1]


def scored(docs: DataFrame, weights: DataFrame, known: frozenset[str], order: int = ORDER) -> DataFrame:
    """(doc_id, lang, chars, nats): lang is that of the model used; nats the mean negative log probability. Columns
    _0, _1 and so on of docs are passed on with their rows, and the text as _text if there are such."""
    extra = [c for c in docs.columns if c not in ("doc_id", "lang", "text")]
    passed = {c: docs.schema[c].dataType for c in extra} | ({"_text": StringType()} if extra else {})
    schema = StructType([StructField("doc_id", LongType()), StructField("lang", StringType()), StructField("chars", LongType()), StructField("nats", DoubleType()), *[StructField(c, kind) for c, kind in passed.items()]])

    def keys_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        k = Grams(rows, known, order).keys()
        return k, np.ones(len(k), np.uint64)

    def use(rows: pa.Table, both: tuple[np.ndarray, np.ndarray], block: str) -> pa.Table:
        g = Grams(rows, known, order)
        nats = g.scores(g.keys(), *both)
        lang = [x if x in known else EVERY for x in rows.column("lang").to_pylist()]
        return pa.table({"doc_id": rows.column("doc_id"), "lang": pa.array(lang, pa.string()), "chars": pa.array(g.chars), "nats": pa.array(nats / np.maximum(g.chars, 1), mask=g.chars == 0), **{c: rows.column("text" if c == "_text" else c) for c in passed}})

    docs = steady(docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("lang"), "text", *extra))
    blocks = Blocks(docs, BLOCK_BYTES, deal=lambda batch: np.array([(x or "").endswith(":1") for x in batch.column("lang").to_pylist()], bool))
    shards, salts = max(16, weights.count() // SHARD_GRAMS + 1), text_total(docs) // SALT_BYTES + 1
    found = looked_up(ask(blocks, keys_of, shards, fan=shards), weights, shards, salts)
    return answered(blocks, found, use, schema, unpack=unpack_pairs)


def quantiles(values: DataFrame, quantile: float) -> dict[str, float]:
    """Each language's exact quantile of (lang, value), between ranks as percentile() has it.

    Values are counted in bins of a thousandth; only the bins that hold the two ranks are sorted, so that no task gets
    all values of a language.
    """
    by_bin, by_value = Window.partitionBy("lang").orderBy("bin"), Window.partitionBy("lang", "bin").orderBy("value")
    binned = written(values.groupBy("lang", F.floor(F.col("value") * 1000).alias("bin"), "value").agg(F.count("*").alias("n")))
    bins = binned.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    bins = bins.select("lang", "bin", (F.sum("n").over(by_bin) - F.col("n")).alias("before"), F.col("n").alias("here"), F.sum("n").over(Window.partitionBy("lang")).alias("all"))
    at = (F.col("all") - 1) * F.lit(quantile)
    bins = bins.filter((F.col("before") <= F.ceil(at)) & (F.col("before") + F.col("here") > F.floor(at)))
    upto = F.sum("n").over(by_value) + F.col("before")
    near = binned.join(F.broadcast(bins), ["lang", "bin"]).withColumn("upto", upto).withColumn("at", at)  # two bins a language
    low, high = (F.min(F.when(F.col("upto") > end, F.col("value"))) for end in (F.floor("at"), F.ceil("at")))
    found = near.groupBy("lang").agg(low.alias("low"), high.alias("high"), F.first("at").alias("at")).collect()  # a row per language
    return {r["lang"]: r["low"] + (r["high"] - r["low"]) * (r["at"] - math.floor(r["at"])) for r in found}


def named(lang: Column, fold: Column) -> Column:
    return F.concat(lang, F.lit(":"), fold.cast("string"))


def judged(docs: DataFrame, labels: DataFrame, sample: int | None = None, quantile: float = QUANTILE, margin: float = MARGIN, short: float = SHORT) -> DataFrame:
    """(doc_id, lang, chars, nats, threshold, kept) for every row, with what scored() passes on.

    sample has no effect any more: nothing bounds the documents that train or set thresholds.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string").alias("lang"), "text", *[c for c in docs.columns if re.fullmatch(r"_\d+", c)])
    trusted = labels.filter("quality = 1 and toxic = 0").select(F.col("doc_id").cast("long"))
    pairs = written(docs.select("doc_id", "lang").join(trusted, "doc_id", "left_semi").distinct())
    known = frozenset(r["lang"] for r in pairs.groupBy("lang").count().filter(F.col("lang").isNotNull() & (F.col("count") >= LEAST)).collect())  # a row per language with models of its own
    model_lang = F.when(F.col("lang").isin(*sorted(known)), F.col("lang")).otherwise(EVERY) if known else F.lit(EVERY)
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    shares = not docs.filter(model_lang == EVERY).isEmpty()  # else nothing is compared with the shared models
    ids = pairs.select("doc_id").distinct()
    ids = F.broadcast(ids) if pairs.count() <= BROADCAST_IDS else ids
    train = docs.select("doc_id", "lang", "text").join(ids, "doc_id", "left_semi")
    counts = written(gram_counts(train.select(named(model_lang, fold).alias("lang"), "text")))
    if shares:
        every = counts.groupBy(named(F.lit(EVERY), F.substring("lang", -1, 1)).alias("lang"), "gram").agg(F.sum("c").alias("c"))
        counts = written(counts.filter(~F.startswith("lang", F.lit(f"{EVERY}:"))).unionByName(every))
    weights = written(model_of(counts))
    names = frozenset(f"{lang}:{k}" for lang in known | {EVERY} for k in (0, 1))
    unnamed = F.expr("substring(lang, 1, length(lang) - 2)").alias("lang")
    by_other = lambda df, lang: scored(df.withColumn("lang", named(lang, 1 - fold)), weights, names)
    scores = by_other(docs, model_lang)
    scores = written(scores.select(*[unnamed if c == "lang" else c for c in scores.columns]))
    only = scores.select("doc_id", "lang", "chars", "nats")
    less = F.col("nats") - short / F.sqrt("chars")
    values = only.filter(F.col("lang") != EVERY).join(pairs, ["doc_id", "lang"], "left_semi")
    if shares:
        values = values.unionByName(by_other(train, F.lit(EVERY)).select("doc_id", unnamed, "chars", "nats"))
    limits = quantiles(values.filter("nats is not null").select("lang", less.alias("value")), quantile)
    line = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("lang")] + margin + short / F.sqrt("chars") if limits else F.lit(None).cast("double")
    return scores.withColumn("threshold", line).withColumn("kept", F.coalesce(F.col("nats") <= F.col("threshold"), F.lit(True)))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier keeps; rows that share a doc_id, and so its labels, are judged each.

    Whole rows go with their scores through the blocks, so no join brings texts and decisions together.
    """
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select("doc_id", "lang", "text", *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)])
    kept = judged(rows, labels).filter("kept")
    return kept.select(*[F.col("_text" if c == "text" else f"_{others.index(c)}").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
