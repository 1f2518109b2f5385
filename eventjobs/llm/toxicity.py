"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are given for documents, the field needs them for tokens: a greedy cover picks the fewest token features
(words, and beginnings of longer words, which find a stem in all its forms) that explain the toxic documents of the
training sample and hardly occur in its clean ones, each in more toxic documents than chance would bring together;
the tokens of toxic documents that have one are the labelled tokens. The field has two states, hashed features of a
token and of the word before it, and transitions; it is trained by its exact gradient over whole texts, some of them
at a time, in numpy. A document's forward-backward marginals give the offending spans, and a logistic function of their
sum, maximum and mean gives the score.

Forward and backward passes run over fixed segments at once: every segment's 2 x 2 product first, then the messages
from segment to segment, then the tokens inside, which is the exact chain over the whole text, however long.

Defined cases. A null or empty text has no token: its score is the logistic function's at zero. Labels that are null or
not 0 or 1 take no part; without labelled rows of both kinds every score is the share of label 1, or 0.5. Very long
texts are used whole, in memory of the longest. Equal texts have equal scores; rows that repeat a doc_id are scored
each. Other columns pass through; columns named score or spans give way. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Words, mix, passes, powers, text_passes, trimmed

SEGMENT = 64
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


@dataclass(frozen=True)
class Params:
    """buckets: of the feature table. beginnings: lengths (bytes) of words that go on. each: training documents of either label at most, the only bound. rounds: over the sample at least. steps: of the descent at least. chance: of one covering feature that means nothing. lift: of a covering feature, in toxic over clean documents."""

    buckets: int = 1 << 18
    beginnings: tuple[int, ...] = (4, 5, 6, 7, 8)
    each: int = 2000
    rounds: int = 6
    steps: int = 150
    rate: float = 0.1
    decay: float = 1e-6
    chance: float = 0.05
    lift: float = 5.0


@dataclass
class Model:
    weights: np.ndarray
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    output: np.ndarray = field(default_factory=lambda: np.zeros(4))


class Tokens:
    """Words without surrounding punctuation, in lower case, of some texts, with their features' buckets."""

    def __init__(self, texts: list[bytes], p: Params):
        words = Words([t.lower() for t in texts], hashed=False)
        buf = words.buf.copy()
        # The capital letters of Latin-1 in UTF-8 (C3 80 to C3 9E): their small ones have the same length.
        after = np.zeros(buf.size, dtype=bool)
        after[1:] = buf[:-1] == 0xC3
        capital = after & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)
        buf[capital] += 0x20
        words.buf = buf
        starts, ends = trimmed(_PUNCT[buf], words.starts, words.ends)
        sums = words.prefix()
        down = powers(buf.size)[1]
        hashed = lambda e: mix((sums[e] - sums[starts]) * down[starts])
        word = hashed(ends)
        before = np.zeros(word.size, dtype=np.uint64)
        before[1:] = word[:-1]
        inner = words.first[:-1][words.first[:-1] < word.size]
        before[inner] = 0
        kinds = [word] + [np.where(ends - starts > n, mix(hashed(np.minimum(starts + n, ends)) + np.uint64(n)), np.uint64(n)) for n in p.beginnings]
        self.own = len(kinds)
        kinds.append(mix(before * np.uint64(5) + np.uint64(77)))
        self.features = np.stack([(h >> np.uint64(40)).astype(np.int64) & (p.buckets - 1) for h in kinds], axis=1) if word.size else np.zeros((0, len(kinds)), dtype=np.int64)
        self.first, self.words, self.starts, self.ends = words.first, words, starts, ends

    def lean(self) -> Tokens:
        """Itself without the texts' bytes, the features in half the room."""
        self.features = self.features.astype(np.int32)
        self.words = self.starts = self.ends = None
        return self


def segments(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with the tokens first[k] to first[k + 1]: each segment's text, place in it, first token and size."""
    sizes = np.diff(first)
    n = -(-sizes // SEGMENT)
    text = np.repeat(np.arange(n.size), n)
    place = np.arange(text.size) - np.repeat(np.cumsum(n) - n, n)
    start = first[:-1][text] + place * SEGMENT
    return text, place, start, np.minimum(SEGMENT, first[1:][text] - start)


def passed(scores: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Forward and backward messages (segments, SEGMENT, 2), potentials of state 1, and which tokens are there."""
    text, place, start, size = segments(first)
    there = np.arange(SEGMENT) < size[:, None]
    at = np.where(there, start[:, None] + np.arange(SEGMENT), 0)
    w = np.where(there, np.exp(np.clip(scores, -25, 25))[at] if scores.size else 0, 1.0)
    (a, b), (c, d) = np.exp(moves)
    s = text.size
    product = np.zeros((s, 2, 2))
    product[:, 0, 0] = product[:, 1, 1] = 1
    for t in range(SEGMENT):
        here = there[:, t, None]
        zero = product[:, :, 0] * a + product[:, :, 1] * c
        one = (product[:, :, 0] * b + product[:, :, 1] * d) * w[:, t, None]
        product[:, :, 0] = np.where(here, zero, product[:, :, 0])
        product[:, :, 1] = np.where(here, one, product[:, :, 1])
        if t % 8 == 7:
            product /= product.max(axis=(1, 2), keepdims=True)
    into, out = np.full((s, 2), 0.5), np.ones((s, 2))
    by_place = np.argsort(place, kind="stable")
    bounds = np.searchsorted(place[by_place], np.arange(place.max() + 2 if s else 1))
    last = np.append(text[1:] != text[:-1], True) if s else np.zeros(0, dtype=bool)
    for k in range(1, bounds.size - 1):
        now = by_place[bounds[k] : bounds[k + 1]]
        x = np.einsum("si,sij->sj", into[now - 1], product[now - 1])
        into[now] = x / x.sum(axis=1, keepdims=True)
    for k in reversed(range(bounds.size - 1)):
        now = by_place[bounds[k] : bounds[k + 1]]
        now = now[~last[now]]
        x = np.einsum("sij,sj->si", product[now + 1], out[now + 1])
        out[now] = x / x.sum(axis=1, keepdims=True)
    forward, backward = np.empty((SEGMENT, s, 2)), np.empty((SEGMENT, s, 2))
    zero, one = into[:, 0], into[:, 1]
    for t in range(SEGMENT):
        x, y = zero * a + one * c, (zero * b + one * d) * w[:, t]
        total = x + y
        zero, one = np.where(there[:, t], x / total, zero), np.where(there[:, t], y / total, one)
        forward[t, :, 0], forward[t, :, 1] = zero, one
    zero, one = out[:, 0], out[:, 1]
    for t in reversed(range(SEGMENT)):
        backward[t, :, 0], backward[t, :, 1] = zero, one
        x, y = a * zero + b * w[:, t] * one, c * zero + d * w[:, t] * one
        total = x + y
        zero, one = np.where(there[:, t], x / total, zero), np.where(there[:, t], y / total, one)
    return forward, backward, w, there, into


def marginals(scores: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each token's probability of state 1."""
    if not scores.size:
        return np.zeros(0)
    forward, backward, _, there, _ = passed(scores, moves, first)
    both = forward * backward
    return (both[:, :, 1] / both.sum(axis=2)).T[there]


def covering(parts: list[Tokens], labels: np.ndarray, p: Params) -> np.ndarray:
    """The buckets that mark toxic tokens: greedily the one in most toxic documents that no chosen one explains."""
    found, at, counts = [], 0, np.zeros((2, p.buckets), dtype=np.int64)
    for t in parts:
        own = at + np.repeat(np.arange(t.first.size - 1), np.diff(t.first))
        pairs = np.unique(own[:, None] * p.buckets + t.features[:, : t.own])
        doc, bucket = pairs // p.buckets, pairs % p.buckets
        for label in (0, 1):
            counts[label] += np.bincount(bucket[labels[doc] == label], minlength=p.buckets)
        found.append(pairs[labels[doc] == 1])
        at += t.first.size - 1
    pairs = np.concatenate(found)
    # A usable feature is `lift` times as frequent in toxic documents, and its documents' labels are none of chance's.
    n_toxic, chosen = int((labels == 1).sum()), []
    base, n = n_toxic / labels.size, counts.sum(axis=0)
    share = counts[1] / np.maximum(1, n)
    clean = np.where(share < 1, (1 - share) * np.log(np.maximum(1e-300, 1 - share) / (1 - base)), 0.0)
    surprise = n * (share * np.log(np.maximum(1e-300, share) / base) + clean)
    usable = (counts[1] * (labels.size - n_toxic) >= p.lift * counts[0] * n_toxic) & (surprise >= math.log(p.buckets / p.chance)) & (share > base)
    pairs = pairs[usable[pairs % p.buckets]]
    doc, bucket = pairs // p.buckets, pairs % p.buckets
    # First every document is to be explained once; then, by frequent features only, up to three times.
    for times, often in ((1, 2), (3, round(0.02 * n_toxic))):
        explained = np.bincount(doc[np.isin(bucket, chosen)], minlength=labels.size)
        open_pair = (explained[doc] < times) & ~np.isin(bucket, chosen) & (counts[1][bucket] >= often)
        d, f = doc[open_pair], bucket[open_pair]
        while f.size:
            n = np.bincount(f, minlength=p.buckets)
            best = int(n.argmax())
            if n[best] < 2:
                break
            chosen.append(best)
            explained[d[f == best]] += 1
            left = (explained[d] < times) & (f != best)
            d, f = d[left], f[left]
    return np.array(chosen, dtype=np.int64)


def summary(p1: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each text: 1, log of 1 + the sum of marginals, their maximum, and 10 times their mean, at most 1."""
    sums = np.concatenate([[0.0], np.cumsum(p1)])
    total = sums[first[1:]] - sums[first[:-1]]
    n = np.diff(first)
    most = np.zeros(n.size)
    full = np.flatnonzero(n)
    if full.size:
        most[full] = np.maximum.reduceat(p1, first[:-1][full])
    return np.stack([np.ones(n.size), np.log1p(total), most, np.minimum(1, 10 * total / np.maximum(1, n))], axis=1)


def slopes(weights: np.ndarray, moves: np.ndarray, features: np.ndarray, y: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gradient of minus the log likelihood of the states y of whole texts, by weights and by moves."""
    forward, backward, potential, there, into = passed(weights[features].sum(axis=1), moves, first)
    both = forward * backward
    wrong = (both[:, :, 1] / both.sum(axis=2)).T[there] - y
    slope = np.bincount(features.ravel(), np.repeat(wrong, features.shape[1]), minlength=weights.size)
    # Each token with the one before it: of the first of a segment, what came into the segment; a text's first has none.
    before = np.concatenate([into[None], forward[:-1]])
    ahead = np.stack([backward[:, :, 0], backward[:, :, 1] * potential.T], axis=2)
    pair = before[:, :, :, None] * np.exp(moves) * ahead[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    _, place, _, _ = segments(first)
    inner = there.T.copy()
    inner[0] &= place > 0
    seen = np.zeros((2, 2))
    follows = np.ones(y.size, dtype=bool)
    follows[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(follows)
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    return slope, pair[inner].sum(axis=0) - seen


def train(sample: pd.DataFrame, p: Params) -> Model:
    """The field and the output function from texts and document labels (0 or 1)."""
    model = Model(np.zeros(p.buckets))
    if not len(sample) or sample["label"].nunique() < 2:
        share = sample["label"].mean() if len(sample) else 0.5
        model.output[0] = np.log((share + 1e-3) / (1 - share + 1e-3))
        return model
    labels = sample["label"].to_numpy()
    texts = [t.encode() for t in sample["text"]]
    parts = [Tokens(texts[a:b], p).lean() for a, b in passes(texts)]  # some texts at a time
    mark = np.zeros(p.buckets, dtype=bool)
    mark[covering(parts, labels, p)] = True
    bounds = np.concatenate([[0], np.cumsum([t.first.size - 1 for t in parts])])
    rng = np.random.default_rng(3)
    state = [(v, np.zeros_like(v), np.zeros_like(v)) for v in (model.weights, model.moves)]
    rounds = max(p.rounds, -(-p.steps // len(parts)))
    step, steps = 0, rounds * len(parts)
    for _ in range(rounds):
        for k in rng.permutation(len(parts)):
            t = parts[k]
            if not t.features.size:
                continue
            y = mark[t.features[:, : t.own]].any(axis=1) & np.repeat(labels[bounds[k] : bounds[k + 1]] == 1, np.diff(t.first))
            slope, move_slope = slopes(model.weights, model.moves, t.features, y.astype(float), t.first)
            slope += p.decay * y.size * model.weights
            step += 1
            for (v, mean, square), g in zip(state, (slope, move_slope), strict=True):
                mean *= 0.9
                mean += 0.1 * g
                square *= 0.99
                square += 0.01 * g * g
                v -= p.rate * (1 - 0.9 * step / steps) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    z = np.concatenate([summary(marginals(model.weights[t.features].sum(axis=1), model.moves, t.first), t.first) for t in parts])
    for _ in range(4000):
        wrong = (1 / (1 + np.exp(-np.clip(z @ model.output, -30, 30))) - labels) / labels.size
        model.output -= 2.0 * (z.T @ wrong + 1e-4 * model.output)
    return model


def scored(texts: list[bytes], model: Model, p: Params, with_spans: bool) -> pa.StructArray:
    """score and spans of each text."""
    scores, ends, found = np.zeros(len(texts)), np.zeros(len(texts) + 1, dtype=np.int64), []
    for a, b in passes(texts):
        tokens = Tokens(texts[a:b], p)
        p1 = marginals(model.weights[tokens.features].sum(axis=1), model.moves, tokens.first)
        scores[a:b] = 1 / (1 + np.exp(-np.clip(summary(p1, tokens.first) @ model.output, -30, 30)))
        hit = np.flatnonzero(p1 >= 0.5) if with_spans else np.zeros(0, dtype=np.int64)
        doc = np.searchsorted(tokens.first, hit, side="right") - 1
        ends[a + 1 : b + 1] = np.bincount(doc, minlength=b - a)
        points = np.concatenate([[0], np.cumsum((tokens.words.buf & 0xC0) != 0x80)])
        begin = points[tokens.starts[hit]]
        found.append((begin - points[tokens.words.text_at[:-1][doc]], points[tokens.ends[hit]] - begin, p1[hit]))
    parts = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0)] * 3
    spans = pa.StructArray.from_arrays([pa.array(parts[0].astype(np.int64)), pa.array(parts[1].astype(np.int64)), pa.array(parts[2].astype(float))], names=["start", "length", "probability"])
    return pa.StructArray.from_arrays([pa.array(scores), pa.ListArray.from_arrays(pa.array(np.cumsum(ends).astype(np.int32)), spans)], names=["score", "spans"])


def score_toxicity(documents: DataFrame, model: Model, p: Params = Params(), with_spans: bool = True) -> DataFrame:
    """documents with score (probability of label 1) and spans (start, length in code points of the text, probability of each toxic token). Only texts go to Python."""

    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [scored(some, model, p, with_spans) for _, _, some in text_passes(texts)]
            yield pa.concat_arrays(parts) if parts else scored([], model, p, with_spans)

    found = F.arrow_udf(judged, "score double, spans array<struct<start:bigint,length:bigint,probability:double>>")
    others = [c for c in documents.columns if c not in ("score", "spans")]
    done = documents.select(*others, found(F.col("text").cast("string")).alias("spans"))
    return done.select(*others, F.col("spans.score").alias("score"), F.col("spans.spans").alias("spans"))
