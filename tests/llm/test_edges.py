"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, operator by operator."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventjobs.llm import chat_format, decontaminate, minhash_dedup, packing, substring_dedup, topk, url_filter
from tests.llm.test_operators import docs

LONG = " ".join(f"w{k % 9973}x{k % 101}" for k in range(200_000))


def test_near_duplicates(spark):
    df = docs(spark, [LONG, LONG + " z", None, "", "a b", "a b"], [5, 3, 1, None, 7, 7]).withColumns({"kept": F.lit("clash"), "component_id": F.lit("clash")})
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(df).collect())
    assert got == [(-1, None, True), (1, 1, True), (3, 3, True), (5, 3, False), (7, 7, True), (7, 7, True)]
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


def test_decontamination(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog at noon"), (1, "one two and three are numbers that we all know by heart"), (None, "no id here but words enough to be found again")], "item_id long, text string")
    texts = [LONG + " the quick brown fox jumps over the lazy dog at noon " + LONG, "so one two and three are numbers that we all know by heart", "clean", "clean", None]
    df = docs(spark, texts, [1, None, 2, 2, None]).withColumns({"contaminated": F.lit("clash"), "n_items": F.lit("clash")})
    got = [(r.doc_id, r.contaminated) for r in decontaminate.judge_contamination(df, bench).collect()]
    assert sorted(map(str, got)) == sorted(map(str, [(1, True), (None, True), (2, False), (2, False), (None, False)]))
    assert decontaminate.clean_documents(df, bench).count() == 3


def test_substring_dedup(spark):
    df = docs(spark, [LONG, "x " + LONG, None, "a", "a"], [1, 2, None, 3, 3]).withColumn("kept_text", F.lit("clash"))
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect()}
    assert got[2] == (200_001, 200_000) and got[None] == (0, 0) and got[3] == (1, 0)


def test_packing(spark):
    import public_tokenizers

    p = packing.Params(tokenizer=public_tokenizers.path("byte_bpe_50k.json"), capacity=64, gathered=500)
    df = docs(spark, ["a b", "a b", None, "c " * 300], [None, None, 4, 4]).withColumn("sequence_id", F.lit("clash"))
    for rows, total in ((packing.pack_best_fit(df, p), None), (packing.pack_harmonic(df, p), None)):
        assert rows.count() > 0
    ids = sum(np.frombuffer(r.input_ids, "<u2")[: r.n_tokens].size for r in packing.pack_best_fit(df, p).collect())
    assert ids == packing.pack_harmonic(df, p).agg(F.sum("length")).first()[0]
    assert packing.pack_best_fit(df.limit(0), p).count() == 0


def test_urls(spark):
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, action string")
    df = spark.createDataFrame([(1, "http://a.com/" + "x" * 200_000, "v"), (1, "http://a.com/", "v"), (None, None, "v"), (2, "", "v")], "page_id long, url string, verdict string")
    assert sorted(r.verdict for r in url_filter.judge_urls(df, rules).collect()) == ["allow", "allow", "block", "block"]
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0


def test_top_k(spark):
    df = spark.createDataFrame([(1, [0.5] * 5000, "x"), (2, [0.5] * 5000, "x"), (3, [0.25], "x")], "vec_id long, embedding array<double>, score string")
    got = topk.top_k(df.select("vec_id", topk.quantised(F.col("embedding")).alias("v"), "score"), F.col("vec_id") == 1, 5).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 2, 128 * 128 * 5000), (2, 3, 128 * 64)]


def test_chat(spark):
    df = spark.createDataFrame([("{}",), ('{"messages":[]}',), ('{"messages":"no list"}',), ("[1]",), ('{"prompt":null,"response":null}',)], "record string").withColumns({"formatted": F.lit("clash"), "turns": F.lit("clash")})
    got = chat_format.format_chats(df).collect()
    assert [r.layout for r in got] == ["unknown", "unknown", "unknown", "unknown", "prompt"] and [len(r.turns) for r in got] == [0, 0, 0, 0, 2]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages(spark, stage):
    """Each stage on nulls, empties, repeats and an empty table."""
    f = dict(corpus_pipeline.STAGES)[stage]
    small = "/root/testdata/sf0.001"
    df = docs(spark, [None, "", "a b c", "a b c", "x", "y"], [1, 2, 3, 3, None, None])
    out = f(spark, df, small)
    assert f(spark, df.limit(0), small).count() == 0
    if stage == "packed":
        ends = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
        assert ends[1] == ends[2] == 1 and set(ends) == {1, 2, 3, None}
        return
    assert out.columns == df.columns
    if stage == "near_copies":
        assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(map(str, [(1, None), (2, ""), (3, "a b c"), (None, "x"), (None, "y")]))
    elif stage != "quality":
        assert out.count() == 6
