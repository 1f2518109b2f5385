"""The pipeline's stages against brute force on the smallest tables."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        out[name] = (docs.toPandas(), spark.read.parquet(path).toPandas())
        docs = spark.read.parquet(path)
    return out


def test_stages_keep_the_columns(stages):
    assert list(stages) == ["quality", "near_copies", "repeats", "decontaminated", "packed"]
    for name in list(stages)[:-1]:
        assert list(stages[name][1].columns) == corpus_pipeline.COLUMNS and set(stages[name][1].doc_id) <= set(stages[name][0].doc_id)


def test_decisions_take_effect(spark, stages):
    from tests.llm.test_operators import WORD, brute_components, brute_repeats

    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas().set_index("doc_id").quality
    before, after = stages["quality"]
    held = before[before.doc_id.isin(labels.index)]
    assert (held.doc_id.isin(after.doc_id) == (labels.loc[held.doc_id].to_numpy() == 1)).mean() > 0.95
    before, after = stages["near_copies"]
    want = brute_components(list(before.text), list(before.doc_id), 5)
    assert set(after.doc_id) == {i for i, (_, _, kept) in want.items() if kept}
    before, after = stages["repeats"]
    want = {i: removed for i, _, removed, _ in brute_repeats([(i, WORD.findall(t or "")) for i, t in zip(before.doc_id, before.text, strict=True)], 20)}
    texts = dict(zip(after.doc_id, after.text, strict=True))
    assert all(len(WORD.findall(texts[i])) == len(WORD.findall(t)) - want[i] for i, t in zip(before.doc_id, before.text, strict=True))
    before, after = stages["decontaminated"]
    items = [" ".join(t.split()) for t in spark.read.parquet(f"{SMALL}/benchmark.parquet").toPandas().text]
    leaks = {i for i, t in zip(before.doc_id, before.text, strict=True) if any(x in " ".join(t.split()) for x in items)}
    assert leaks and set(before.doc_id) - set(after.doc_id) == leaks
    before, after = stages["packed"]
    assert after.groupby("doc_id").length.sum().sum() == after.drop_duplicates("doc_id").doc_tokens.sum() and set(after.doc_id) == set(before.doc_id)


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SMALL).agg(F.count("*"), F.sum("length"), F.sum("ids_crc32")).first()
    rows = stages["packed"][1]
    assert got[1] == rows.length.sum() and got[0] > 0


def test_near_copies_are_judged_by_row(spark):
    words = [f"w{k}" for k in range(60)]
    one, near, other, third = " ".join(words), " ".join([*words, "x"]), " ".join(reversed(words)), " ".join(words[::2] + words[1::2])
    rows = [(1, one), (2, near), (2, other), (3, third), (3, third), (4, ""), (4, ""), (4, other + " y z"), (None, one), (None, one), (5, "a b c d e f"), (5, "f e d c b a")]
    df = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, df, SMALL).collect()), key=str)
    assert got == sorted([(1, one), (2, other), (3, third), (4, ""), (None, one), (None, one), (5, "a b c d e f"), (5, "f e d c b a")], key=str)
    same = spark.createDataFrame([(7, one, "en", None, None), (7, near, "en", None, None)], df.schema)
    assert corpus_pipeline.near_copies(spark, same, SMALL).count() == 1


def test_long_texts_reach_python_in_small_batches(spark, monkeypatch):
    """Every stage bounds the bytes that a worker and its executor hold at once; all rows arrive; a setting of the session's own stays."""
    from eventjobs.llm import packing, shared

    def seen(batches, p, with_ids):
        for batch in batches:
            yield packing.pa.RecordBatch.from_pylist([{"doc_id": batch.num_rows, "length": batch.nbytes}], schema=packing.PIECE)

    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    monkeypatch.setattr(packing, "_harmonic", seen)
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b "), F.expr("repeat('x', 20000)"), F.col("id")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(20007).cast("long").alias("n_chars")).coalesce(1)
    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset(bound)
        done = stage(spark, df if name == "packed" else df.limit(3), SMALL)
        assert spark.conf.get(bound) == str(shared.BATCH_BYTES), name
    got = done.collect()
    assert sum(r.doc_id for r in got) == 1000 and max(r.length for r in got) < 1.1 * shared.BATCH_BYTES
    spark.conf.set(bound, "1m")
    own = corpus_pipeline.packed(spark, df, SMALL).collect()
    spark.conf.unset(bound)
    assert sum(r.doc_id for r in own) == 1000 and max(r.length for r in own) < 1.1 * (1 << 20)
