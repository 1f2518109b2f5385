"""Quality classifier with supervised subword embeddings.

A document is the mean of learned vectors of its hashed words, word pairs and character n-grams (bytes), and a softmax
over two classes reads that mean. Training is numpy stochastic gradient descent on a bounded sample of labelled
documents. As the output is linear in the mean, a document's score is the mean of one number per hash bucket, which
is what the workers look up: a table of fixed size, whatever the corpus.

Defined cases. A null or empty text has no features: its score is that of the output's bias, the class share of the
training sample. Long texts are used whole. Labels that are null or not 0 or 1 take no part; of repeated labels of a
document the larger counts; without any labelled row every score is 0.5, and with labels of one kind only the share
of label 1. Equal texts have equal scores; rows that repeat a doc_id are scored each. Other columns pass through,
whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, mix, passes, text_passes


@dataclass(frozen=True)
class Params:
    """buckets: of the hash table. grams: lengths of byte n-grams. dims: of a vector. each: documents of a class in the training sample at most."""

    buckets: int = 1 << 18
    grams: tuple[int, ...] = (3, 4)
    dims: int = 8
    each: int = 2000
    epochs: int = 5
    rate: float = 0.5
    seed: int = 5


def _folded(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int64) & (buckets - 1)


def features(texts: list[bytes], p: Params) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every feature of the texts, text by text, and where each text's begin (one more at the end)."""
    words = Words(texts)
    pairs = mix(words.hashes[:-1] * np.uint64(3) + words.hashes[1:]) if words.hashes.size else words.hashes
    same = words.hashes[:-1] == words.hashes[1:]
    pairs = np.where(same, np.uint64(0x1234567890ABCDEF), pairs)  # a word and itself again is one pair, whichever word
    kinds = [(words.hashes, words.first)]
    text = np.searchsorted(words.first, np.arange(pairs.size), side="right") - 1
    inside = np.arange(pairs.size) + 1 < words.first[1:][text] if pairs.size else np.zeros(0, dtype=bool)
    kinds.append((pairs[inside], np.concatenate([[0], np.cumsum(np.bincount(text[inside], minlength=len(texts)))])))
    code = words.buf.astype(np.uint64)
    for n in p.grams:
        packed = np.zeros(max(0, code.size - n + 1), dtype=np.uint64)
        for k in range(n):
            packed = packed << np.uint64(8) | code[k : k + packed.size]
        ends = np.maximum(words.text_at[1:] - n, words.text_at[:-1])  # the separating space does not count
        keep = np.zeros(packed.size + 1, dtype=np.int64)
        np.add.at(keep, words.text_at[:-1].clip(max=packed.size), 1)
        np.add.at(keep, ends.clip(max=packed.size), -1)
        held = np.cumsum(keep[:-1]) > 0
        before = np.concatenate([[0], np.cumsum(held)])
        kinds.append((mix(packed[held] * np.uint64(2 * n + 1)), before[words.text_at.clip(max=packed.size)]))
    total = sum(np.diff(at) for _, at in kinds)
    starts = np.concatenate([[0], np.cumsum(total)])
    out = np.zeros(starts[-1], dtype=np.int32)
    offset = starts[:-1].copy()
    for hashes, at in kinds:
        sizes = np.diff(at)
        out[np.repeat(offset - at[:-1], sizes) + np.arange(hashes.size)] = _folded(hashes, p.buckets)
        offset += sizes
    return out, starts


def train(sample: pd.DataFrame, p: Params) -> tuple[np.ndarray, float]:
    """The score table (one number per bucket) and the bias, from texts and labels."""
    if not len(sample) or sample["label"].nunique() < 2:
        share = sample["label"].mean() if len(sample) else 0.5
        return np.zeros(p.buckets, dtype=np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    texts = [t.encode() for t in sample["text"]]
    labels = sample["label"].to_numpy()
    rows = []
    for a, b in passes(texts):
        found, at = features(texts[a:b], p)
        for k in range(b - a):
            ids, n = np.unique(found[at[k] : at[k + 1]], return_counts=True)
            rows.append((ids.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    rng = np.random.default_rng(p.seed)
    vectors = rng.normal(0, 0.1, (p.buckets, p.dims)).astype(np.float32)
    output, bias = np.zeros((2, p.dims), dtype=np.float32), np.zeros(2, dtype=np.float32)
    balance = 0.5 / np.maximum(np.bincount(labels, minlength=2) / labels.size, 1e-3)
    steps = p.epochs * len(rows)
    done = 0
    for _ in range(p.epochs):
        for k in rng.permutation(len(rows)):
            ids, share = rows[k]
            rate = p.rate * (1 - done / steps) + 0.01
            done += 1
            own = vectors[ids]
            mean = share @ own
            z = output @ mean + bias
            e = np.exp(z - z.max())
            wrong = e / e.sum()
            wrong[labels[k]] -= 1
            wrong *= rate * balance[labels[k]]
            # The mean's own scale is one part in thousands of each feature, so the vectors take a larger step.
            vectors[ids] = own - np.outer(share * 200, wrong @ output)
            output -= np.outer(wrong, mean)
            bias -= wrong
    return vectors @ (output[1] - output[0]), float(bias[1] - bias[0])


def scores(texts: list[bytes], table: np.ndarray, bias: float, p: Params) -> np.ndarray:
    """Of each text the probability of label 1."""
    out = np.zeros(len(texts))
    for a, b in passes(texts):
        found, at = features(texts[a:b], p)
        sums = np.concatenate([[0.0], np.cumsum(table[found], dtype=np.float64)])
        mean = (sums[at[1:]] - sums[at[:-1]]) / np.maximum(1, np.diff(at))
        out[a:b] = 1 / (1 + np.exp(-np.clip(mean + bias, -30, 30)))
    return out


def score_quality(documents: DataFrame, model: tuple[np.ndarray, float], p: Params = Params()) -> DataFrame:
    """documents with score, the probability of label 1. A column of that name gives way. Only texts go to Python, and only scores come back."""

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [scores(some, *model, p) for _, _, some in text_passes(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    others = [c for c in documents.columns if c != "score"]
    return documents.select(*others, F.arrow_udf(scored, "double")(F.col("text").cast("string")).alias("score"))
