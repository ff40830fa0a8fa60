"""Near-dedup, language models and the classifier against SQL or brute force on small tables."""

import math
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from splatframe.llm import kneser_ney, lm, minhash

TEXTS = [None, "", " \n", "one", "one two", "a b c d e f g h i j k l", "a b c d e f g h i j k l", "A b c d e f g h i j k x", "a b c d e f g h i j x y", "q r s t u v w a b c", "the cat sat on the mat the cat sat", "the cat sat on the rug"]


def frame(spark):
    rows = [(k, t, "en" if k % 3 else None, 0, "x") for k, t in enumerate(TEXTS)]
    rows += [(100 + k, " ".join(f"w{(j * 7) % 40 if j != k else 99}" for j in range(60)), "en", 0, "x") for k in range(50)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n int, node string")


def rows(df):
    return sorted(map(tuple, df[sorted(df.columns)].astype(str).itertuples(index=False)))


@pytest.mark.parametrize("name", ["minhash", "lm"])
def test_matches_sql(spark, tmp_path, name):
    df = frame(spark)
    df.write.parquet(f"file://{tmp_path}/documents.parquet")
    module = {"minhash": minhash, "lm": lm}[name]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert rows(module.query(spark, f"file://{tmp_path}").toPandas()) == rows(db.execute(module.ORACLE_SQL).df())


def test_empty_tables(spark):
    none = frame(spark).limit(0)
    assert minhash.near_duplicates(none).count() == 0
    assert lm.backoff_scores(none).count() == 0


@pytest.mark.parametrize("batch", [3, 10000])
def test_shared_bands_are_all_found(spark, tmp_path, batch):
    """Brute force, with a key in most rows, rows that share an id, and null ids; a row of a shard holds many keys."""
    rnd = random.Random(4)
    rows_ = [(None if k == 5 else k // 2 if k > 50 else k, k % 7, 0, 0, [(b << 58) + rnd.randrange(30) * 0x3A1B2C3D4E5F61 if k % 7 else 0 for b in range(-4, 4)] if k % 7 else []) for k in range(90)]
    rows_ += [(1000 + k, 3, 0, 0, [77, 1 << 62, k]) for k in range(40)]
    spark.createDataFrame(rows_, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>").write.parquet(f"file://{tmp_path}/t")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = Counter(tuple(r) for r in minhash.shared_bands(spark.read.parquet(f"file://{tmp_path}/t"), 8).select("key", "node", "n").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = [(key, i, n) for i, n, _, _, keys in rows_ if i is not None for key in keys]
    times = Counter(key for key, _, _ in found)
    assert got == Counter(x for x in found if times[x[0]] > 1)


def test_unshared_bands_are_not_shuffled_row_by_row(spark, tmp_path):
    df = frame(spark)
    plan = minhash.shared_bands(minhash.written(minhash.features(df, 2)), minhash.BANDS)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange") == 1


def test_probabilities_sum_to_one(spark):
    texts = spark.createDataFrame([("en", "abracadabra abba"), ("en", "cabbage and bread")], "lang string, text string")
    found = {(r.gram): (r.direct, r.gamma) for r in kneser_ney.model(texts).collect()}
    letters = sorted({c for g in found for c in g})

    def p(context, c):
        out = 1 / kneser_ney.ALPHABET
        for n in range(len(context) + 1):
            tail = context[len(context) - n :]
            out = found.get(tail + c, (0.0, 1.0))[0] + found.get(tail, (0.0, 1.0))[1] * out
        return out

    unseen = kneser_ney.ALPHABET - len(letters)
    for context in ("", "a", "ab", "abr", "zzz"):
        assert abs(sum(p(context, c) for c in letters) + unseen * p(context, "☃") - 1) < 1e-6


def slow_scores(texts, train, order):
    """Mean negative log probability of each text, by modified Kneser-Ney counted in dictionaries."""
    pad = lambda t: kneser_ney.PAD * (order - 1) + "".join("0" if c in "0123456789" else c for c in t)
    level = Counter(p[i : i + order] for p in map(pad, train) for i in range(len(p) - order + 1))
    counts = {}
    for n in range(order, 0, -1):
        counts[n] = level
        level = Counter(g[1:] for g in level)  # continuation counts: each longer n-gram once
    tables = {}
    for n, c in counts.items():
        seen = [sum(x == k for x in c.values()) for k in range(1, 5)]
        y = seen[0] / (seen[0] + 2 * seen[1]) if seen[0] else 0.5
        cut = [min(k - 0.01, max(0.05, k - (k + 1) * y * seen[k] / seen[k - 1])) if seen[k - 1] and seen[k] else k / 2 for k in (1, 2, 3)]
        total, taken = Counter(), Counter()
        for g, x in c.items():
            total[g[:-1]] += x
            taken[g[:-1]] += cut[min(x, 3) - 1]
        tables[n] = (c, cut, total, taken)

    def p(context, char):
        out = 1 / kneser_ney.ALPHABET
        for n in range(1, order + 1):
            c, cut, total, taken = tables[n]
            before = context[len(context) - n + 1 :]
            if total[before]:
                x = c[before + char]
                out = (x - cut[min(x, 3) - 1] if x else 0) / total[before] + taken[before] / total[before] * out
        return out

    out = []
    for t in texts:
        q = pad(t or "")
        nats = [-math.log(p(q[i - order + 1 : i], q[i])) for i in range(order - 1, len(q))]
        out.append(sum(nats) / len(nats) if nats else None)
    return out


def test_scores_against_brute_force(spark):
    rnd = random.Random(3)
    train = ["".join(rnd.choices("abcde 12é", [9, 6, 4, 3, 2, 5, 1, 1, 1], k=rnd.randrange(1, 60))) for _ in range(40)]
    texts = [None, "", "a", "0", "abc abc", "☃☃ zz", *train[:5], "".join(rnd.choices("abcdexyz 9", k=5000)), *["ab cd"] * 3]
    weights = kneser_ney.model(spark.createDataFrame([("en", t) for t in train], "lang string, text string"))
    docs = spark.createDataFrame([(k, "en", t) for k, t in enumerate(texts)], "doc_id long, lang string, text string")
    got = {r.doc_id: r.nats for r in kneser_ney.scored(docs, weights, frozenset({"en"})).collect()}
    for k, want in enumerate(slow_scores(texts, train, kneser_ney.ORDER)):
        assert got[k] == (None if want is None else pytest.approx(want, rel=1e-5)), texts[k]


def test_judgement_of_odd_rows(spark):
    """Repeated rows and ids, null languages and columns of clashing names."""
    docs, labels = trusted_texts(spark, {"en": 120})
    odd = [(7, "\x01~" * 400, "en"), (7, "\x01~" * 400, "en"), (7, "", None), (None, None, "en"), (500, "\x01~" * 400, None)]
    both = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("shard", F.lit(1)).withColumn("_text", F.lit("t")).withColumn("kept", F.lit(False))
    kept = kneser_ney.kept_documents(both, labels.filter("doc_id <> 7"))
    assert kept.columns == both.columns
    got = [tuple(r) for r in kept.filter("doc_id = 7 or doc_id is null or doc_id = 500").select("doc_id", "text", "lang", "_text").collect()]
    mine = docs.filter("doc_id = 7").first()
    assert sorted(got, key=repr) == sorted([(7, "", None, "t"), (None, None, "en", "t"), (7, mine.text, "en", "t")], key=repr)


def test_classifier_without_labels_keeps_all(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = kneser_ney.judged(frame(spark), labels)
    assert got.count() == len(TEXTS) + 50 and got.filter("not kept").count() == 0


def trusted_texts(spark, langs):
    """(docs, labels): so many trusted documents of each language, each language with letters of its own."""
    rnd, rows = random.Random(5), []
    for k, (lang, n) in enumerate(langs.items()):
        words = ["".join(chr(0x61 + 0x100 * k + rnd.randrange(20)) for _ in range(rnd.randrange(2, 9))) for _ in range(60)]
        rows += [(1000 * k + i, " ".join(rnd.choices(words, k=30)), lang) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int")


def test_rare_language_gets_its_own_model(spark):
    docs, labels = trusted_texts(spark, {"en": 800, "xx": 40, "yy": 39})
    got = kneser_ney.judged(docs, labels, sample=100).toPandas()
    assert got.groupby("doc_id").lang.first().pipe(lambda x: x.groupby(x.index // 1000).unique().map(list).tolist()) == [["en"], ["xx"], ["*"]]
    assert got[got.lang == "xx"].kept.mean() > 0.9


@pytest.mark.parametrize("share", [False, True])
def test_all_trusted_documents_train_and_are_held_out(spark, share):
    """Brute force: scores by models of all trusted documents of the other fold, thresholds over all of them."""
    docs, labels = trusted_texts(spark, {"en": 90, "xx": 60, **({"yy": 9} if share else {})})
    low = spark.createDataFrame([(5000 + k, "qzj " * (k + 1), "en") for k in range(4)], docs.schema)
    got = {r.doc_id: r for r in kneser_ney.judged(docs.unionByName(low), labels, quantile=0.9).collect()}
    folds = docs.unionByName(low).withColumn("f", F.pmod(F.xxhash64("doc_id"), F.lit(2))).collect()
    for lang in ["en", "xx", "*"][: 3 if share else 2]:
        of = [r for r in folds if lang in ("*", r.lang)]
        want = {}
        for f in (0, 1):
            mine = [r for r in of if r.f == f]
            nats = slow_scores([r.text for r in mine], [r.text for r in of if r.f != f and r.doc_id < 5000], kneser_ney.ORDER)
            want |= {r.doc_id: (r, x) for r, x in zip(mine, nats, strict=True)}
        values = sorted(x - kneser_ney.SHORT / math.sqrt(len(r.text)) for i, (r, x) in want.items() if i < 5000)
        at = 0.9 * (len(values) - 1)
        line = values[int(at)] + (values[math.ceil(at)] - values[int(at)]) * (at - int(at)) + kneser_ney.MARGIN
        for i, (r, x) in want.items():
            if lang == got[i].lang:
                assert got[i].nats == pytest.approx(x, rel=1e-5)
                assert got[i].threshold == pytest.approx(line + kneser_ney.SHORT / math.sqrt(len(r.text)), rel=1e-5)
    assert {r.lang for r in got.values()} == ({"en", "xx", "*"} if share else {"en", "xx"})


@pytest.mark.parametrize("counted", [1 << 18, 50])
def test_grams_are_counted_exactly(spark, counted):
    rows = [("en", "ab\0\0\0" * 9), ("xx", None), ("xx", ""), ("en", "\U0001f389é12"), ("xx", "\U0001f389é99"), ("en", "ab\0" * 40)]
    got = {(r.lang, r.gram): r.c for r in kneser_ney.gram_counts(spark.createDataFrame(rows, "lang string, text string"), counted=counted, at_once=counted).collect()}
    want = Counter()
    for lang, t in rows:
        p = kneser_ney.PAD * 3 + kneser_ney.plain(t or "")
        want.update((lang, p[i : i + 4]) for i in range(len(p) - 3))
    assert got == want


def test_shared_threshold_is_of_the_shared_model(spark):
    docs, labels = trusted_texts(spark, {"en": 300, "yy": 30})
    own = kneser_ney.judged(docs, labels, sample=200, quantile=0.5).filter("lang = '*'").toPandas().set_index("doc_id").sort_index()
    every = kneser_ney.judged(docs.withColumn("lang", F.lit(None).cast("string")), labels, sample=200, quantile=0.5).toPandas().set_index("doc_id").loc[own.index]
    assert len(own) == 30 and (own.threshold - every.threshold).abs().max() < 1e-6


def test_thresholds_cover_all_trusted_documents(spark):
    docs, labels = trusted_texts(spark, {"en": 800})
    got = kneser_ney.judged(docs, labels, sample=100, quantile=1.0, margin=1e-9)
    assert got.filter("not kept").count() == 0


@pytest.mark.parametrize("q", [0.0, 0.5, 0.995, 1.0])
def test_quantiles_are_exact(spark, q):
    rnd = random.Random(1)
    found = [("a", rnd.gauss(2, 0.01)) for _ in range(500)] + [("b", float(rnd.randrange(3))) for _ in range(100)] + [("c", -1.5)]
    df = spark.createDataFrame(found, "lang string, value double")
    want = {r.lang: r.v for r in df.groupBy("lang").agg(F.percentile("value", F.lit(q)).alias("v")).collect()}
    assert kneser_ney.quantiles(df, q) == pytest.approx(want, abs=1e-12)
