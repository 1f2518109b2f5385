"""The corpus pipeline: five operators after one another, each on what its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.

Defined cases. A null or empty text has the score of the quality model's bias; near no text, it stays in near_copies,
loses nothing in repeats, is clean, and packs as the end id alone. Rows are judged by their own texts, whatever their
ids: of whole rows that repeat near_copies keeps one, of rows without a doc_id all. Ties go to the least doc_id, then
text hash. Very long texts are used whole. Further columns of docs are left out, and an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventjobs.llm.decontaminate import clean_documents
from eventjobs.llm.minhash_dedup import judged_rows
from eventjobs.llm.packing import pack_harmonic
from eventjobs.llm.quality import Params as QualityParams
from eventjobs.llm.quality import score_quality
from eventjobs.llm.queries import packing_params, quality_model, table
from eventjobs.llm.shared import bitmap, rows_by_bitmap, small_batches, written
from eventjobs.llm.substring_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The score from which a document is good enough, as in the operator's own query.
GOOD = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    small_batches(spark)
    return score_quality(docs, quality_model(spark, sf_dir), QualityParams()).where(F.col("score") >= GOOD).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays (five words, 0.8), each row judged by its own text; of rows that repeat
    a doc_id in one group the least text_hash, of whole rows that repeat one. Rows without a doc_id all stay."""
    small_batches(spark)
    rows = written(judged_rows(docs).where("doc_id is not null").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), F.first("kept").alias("kept"), F.first("component").alias("component")))
    first = rows.where("kept and component is not null").groupBy("doc_id", "component").agg(F.min("text_hash").alias("least"), F.count("*").alias("texts")).where("texts > 1")
    later = rows.where("kept").join(first, ["doc_id", "component"]).where("text_hash <> least")
    gone = written(rows.where("not kept").select("doc_id", "text_hash").union(later.select("doc_id", "text_hash")))
    hashed = lambda df: df.select(F.xxhash64("doc_id", "text_hash").alias("h"))
    bits = bitmap(hashed(gone).union(hashed(rows.where("n > 1"))), "h")
    text_hash = F.xxhash64("text")
    keyed = docs.where("doc_id is not null").select(F.xxhash64("doc_id", text_hash).alias("h"), text_hash.alias("text_hash"), *COLUMNS)
    doubtful = rows_by_bitmap(keyed, bits, True).join(gone, ["doc_id", "text_hash"], "left_anti")
    others = [c for c in COLUMNS if c not in ("doc_id", "text")]
    once = doubtful.groupBy("doc_id", "text_hash").agg(F.min(F.struct(*others, "text")).alias("row")).select("doc_id", "row.*").select(*COLUMNS)
    return rows_by_bitmap(keyed, bits, False).select(*COLUMNS).union(once).union(docs.where("doc_id is null").select(*COLUMNS))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that repeat an earlier window go from the texts; every document stays."""
    small_batches(spark)
    done = remove_repeats(docs.select(*COLUMNS))
    text = F.col("kept_text")
    return done.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    return clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest as pieces of packed sequences."""
    small_batches(spark)
    return pack_harmonic(docs, packing_params(), with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("decontaminated", decontaminated),
    ("packed", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL: a trained classifier, templates and a tokenizer are not expressible; a test holds run() against brute force.
ORACLE_SQL = None
