"""Repeated rows and shared ids through the stages of the pipeline."""

import random

import corpus_pipeline
from splatframe.llm import kneser_ney, minhash, suffixes


def test_repeated_rows_through_all_stages(spark, tmp_path):
    rnd = random.Random(3)
    text = lambda: " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(120))
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, a), (2, b), (2, c), (3, b), (4, None), (4, None), (5, ""), (None, text())]
    docs = spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    want = [(1, a), (2, b), (2, c), (4, None), (4, None), (5, ""), rows[-1]]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, f"file://{tmp_path}"))
        got = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
        assert got == sorted(rows if name == "quality" else want, key=repr), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, f"file://{tmp_path}").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in packed) == sorted((i is None, i or 0) for i, _ in want)
    assert len({(r.sequence_id, r.offset) for r in packed}) == len(want)


def test_cut_rows_are_not_multiplied(spark):
    df = spark.createDataFrame([(1, "a" * 9 + "bcdefgh", 0), (1, "bcdefgh" + "x" * 2, 0), (1, "qq", 0)], "doc_id long, text string, n_chars long")
    assert sorted(r.text for r in suffixes.without_repeats(df, 7).collect()) == ["", "qq", "xx"]


def test_shared_id_is_judged_row_by_row(spark):
    good = [(i, "abc abd acd bcd " * 8, "en") for i in range(100)]
    docs = spark.createDataFrame([*good, (0, "♠♣♥♦" * 30, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 100)], "doc_id long, quality int, toxic int")
    assert sorted(r.doc_id for r in kneser_ney.kept_documents(docs, labels).collect()) == list(range(100))


def test_smallest_id_stays_of_shared_ids(spark):
    docs = spark.createDataFrame([(7, "a b c d e f g"), (7, "q r s t u v w"), (3, "a b c d e f g"), (3, "z")], "doc_id long, text string")
    assert sorted(map(tuple, minhash.without_near_duplicates(docs).collect())) == [(3, "a b c d e f g"), (3, "z"), (7, "q r s t u v w")]


def stages_input(spark, tmp_path, rows):
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, _spans string, _row long")


def test_passages_of_fifty_words_go_and_lines_stay(spark, tmp_path):
    """Brute force: every run of 50 words that two documents share is cut; shorter ones stay, as do clashing columns."""
    rnd = random.Random(9)
    words = lambda n: [" ".join("".join(rnd.choice("abcdefghijklm") for _ in range(5)) for _ in range(n))]
    passage, line = words(60), words(20)
    texts = [" ".join(words(30) + passage + words(10)), " ".join(passage + words(40)), " ".join(words(8) + line + words(9)), " ".join(line + words(50))]
    docs = stages_input(spark, tmp_path, [(i, t, "en", "x", len(t), "mine", 7) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in corpus_pipeline.suffix_dedup(spark, docs, f"file://{tmp_path}").collect()}
    runs = lambda t, n: {tuple(t.split()[k : k + n]) for k in range(len(t.split()) - n + 1)}
    assert not runs(got[0].text, 50) & runs(got[1].text, 50) and passage[0][10:300] not in got[0].text + got[1].text
    assert [got[k].text for k in (2, 3)] == texts[2:] and all(r.n_chars == len(r.text) and (r["_spans"], r["_row"]) == ("mine", 7) for r in got.values())
    assert len(got[0].text.split()) >= 39 and len(got[1].text.split()) >= 39


def test_empty_table_through_all_stages(spark, tmp_path):
    docs = stages_input(spark, tmp_path, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, f"file://{tmp_path}")
        assert out.count() == 0 and (name == "pack" or out.columns == docs.columns), name
