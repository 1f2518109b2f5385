"""URL filter: a blocked Bloom filter of the listed keys passes possible hits to an exact hash join.

A rule is a host and the beginning of a path. Its key is the host, a slash-free separator and the path. A URL makes
one candidate key for each of its host's suffixes (at label bounds) and each length that a listed path has. The
filter keeps the candidates that may be listed; an exact join on the key removes its false positives, and the longest
rule of a URL wins (by host and path together, then by host, then by the rule's text and action).

Defined cases. A null URL or one without "://": host and path are empty, no rule fits, the default verdict holds.
Rules with a null host or path: the null counts as empty; an empty host fits no URL. Repeated rules count once; of two
rules with the same key the one whose action sorts first wins. Rows that repeat a URL get the same verdict. Further
columns are not looked at. An empty rule table or page table gives default verdicts or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of 512 bits in the filter: 1 MB, whatever the number of rules. Bits that a key sets in its block.
BLOCKS, PROBES = 1 << 14, 6
#: Rules up to this many are broadcast for the exact join; above it Spark shuffles both sides.
BROADCAST_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of each key (int64), and its bits there."""
    x = keys.view(np.uint64)
    block = (x % np.uint64(BLOCKS)).astype(np.int64)
    y = x * np.uint64(0x9E3779B97F4A7C15)
    shifts = np.arange(PROBES, dtype=np.uint64) * np.uint64(9) + np.uint64(10)
    return block, (y[:, None] >> shifts & np.uint64(511)).astype(np.int64)


def bloom(rules: DataFrame) -> np.ndarray:
    """The filter of the column key_hash: built where the rows are, as words of at most BLOCKS * 8 rows."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, bits = _bits(batch.column(0).to_numpy())
            word = (block[:, None] * 8 + (bits >> 6)).ravel()
            mask = np.uint64(1) << (bits & 63).astype(np.uint64).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask.view(np.int64))], names=["word", "mask"])

    found = rules.select("key_hash").mapInArrow(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    out = np.zeros(BLOCKS * 8, dtype=np.uint64)
    out[found["word"].to_numpy(dtype=np.int64)] = found["mask"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def may_hold(filter_words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    block, bits = _bits(keys)
    held = filter_words[block[:, None] * 8 + (bits >> 6)] >> (bits & 63).astype(np.uint64) & np.uint64(1)
    return held.all(axis=1)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages (page_id, url), rules (host, path, action) -> page_id, url, host, path, rule (null if none fits), verdict."""
    rules = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), F.coalesce("action", F.lit(default)).alias("action"))
    rules = rules.where("rule_host <> ''").groupBy("rule_host", "rule_path").agg(F.min("action").alias("action")).withColumn("key", F.concat("rule_host", F.lit("\n"), "rule_path")).withColumn("key_hash", F.xxhash64("key"))
    spark = pages.sparkSession
    held = bloom(rules)
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())  # as many as the longest path has characters
    n_rules = rules.limit(BROADCAST_RULES + 1).count()

    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    starts = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(starts, lambda s: F.concat(h, F.lit("\n"), s))))
    # A verdict depends on the URL alone, so each distinct URL is judged once.
    candidates = rows.where("host <> ''").select("url", "host", "path").distinct().select("url", F.explode(keys).alias("key")).withColumn("key_hash", F.xxhash64("key"))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_hold(held, batch.column(2).to_numpy()))).select([0, 1])

    hits = candidates.mapInArrow(possible, "url string, key string")
    listed = rules.select("key", "rule_host", "rule_path", "action")
    fits = hits.join(F.broadcast(listed) if n_rules <= BROADCAST_RULES else listed, "key")
    best = fits.groupBy("url").agg(F.min(F.struct((-F.length("rule_host") - F.length("rule_path")).alias("a"), (-F.length("rule_host")).alias("b"), F.concat("rule_host", "rule_path").alias("rule"), "action")).alias("best"))
    out = rows.join(best, "url", "left")
    return out.select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
