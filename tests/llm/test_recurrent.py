"""The recurrent language model against loops, numerical gradients and exact counts, and its defined cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eventjobs.llm import recurrent
from eventjobs.llm.labelled import fold
from tests.llm.test_operators import WORD, docs, lowered

SMALL = recurrent.Params(vocabulary=24, classes=5, state=6, window=8, lanes=4, table=40, warm=30, epochs=2)


def counts_of(n=30):
    words = [f"w{k}".encode() for k in range(n)]
    return recurrent.Counts(1000, n + 20, 50, words, np.arange(200, 200 - 3 * n, -3), 24, 120, n + 19 - 22)


def model(seed=1):
    m = recurrent.Model(counts_of(), SMALL)
    rng = np.random.default_rng(seed)
    for name in m.NAMES:
        setattr(m, name, getattr(m, name).astype(np.float64) + rng.normal(0, 0.3, getattr(m, name).shape))
    return m


def plain_likelihood(m, symbols):
    """One document by the definition, one symbol after another."""
    h, state, last, total = m.recurrent.shape[0], np.zeros(m.recurrent.shape[0]), recurrent.END, 0.0
    for s in symbols:
        given, own = m.inputs[last], state @ m.recurrent
        r, z = (1 / (1 + np.exp(-(given[k * h : (k + 1) * h] + own[k * h : (k + 1) * h]))) for k in (0, 1))
        n = np.tanh(given[2 * h :] + r * own[2 * h :])
        state = (1 - z) * n + z * state
        c = int(m.class_of[s])
        a, b = m.starts[c], [*m.starts, m.class_of.size][c + 1]
        for logits, at in ((m.classes @ state + m.class_bias, c), (m.words[a:b] @ state + m.word_bias[a:b], s - a)):
            if logits.size > 1:
                total += logits[at] - math.log(np.exp(logits).sum())
        last = s
    return total


def test_likelihoods_by_definition_and_probabilities_add_up():
    m, rng = model(), np.random.default_rng(2)
    sizes = [1, 70, 3, 3, 0, 17, 1]
    symbols = rng.integers(0, 24, sum(sizes))
    at = np.concatenate([[0], np.cumsum(sizes)])
    got = recurrent.likelihoods(m, symbols, at, 8)
    assert np.allclose(got, [plain_likelihood(m, symbols[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)], rtol=1e-5)
    every = recurrent.log_probabilities(m, np.repeat(rng.normal(size=(1, 6)), 24, axis=0), np.arange(24))
    assert abs(np.exp(every).sum() - 1) < 1e-9


def test_gradient_of_truncated_backpropagation():
    symbols, at = np.random.default_rng(3).integers(0, 24, 8), np.array([0, 5, 8])  # one window, two documents
    m, found = model(), {}

    class Caught:
        def step(self, name, gradient, rows=slice(None)):
            found.setdefault(name, np.zeros(getattr(m, name).shape))[rows] += gradient

    loss = recurrent.learn(m, symbols, at, SMALL, Caught())
    total = lambda: -sum(plain_likelihood(m, symbols[a:b].tolist()) for a, b in ((0, 5), (5, 8))) / 8
    assert abs(loss - total()) < 1e-5
    rng = np.random.default_rng(4)
    for name in m.NAMES:
        weights = getattr(m, name)
        for _ in range(25):
            at_ = tuple(rng.integers(0, n) for n in weights.shape)
            if name in ("words", "word_bias") and m.class_of[at_[0]] == 0:
                continue  # a class of one word has no softmax
            held = weights[at_]
            weights[at_] = held + 1e-5
            up = total()
            weights[at_] = held - 1e-5
            slope = (up - total()) / 2e-5
            weights[at_] = held
            assert abs(slope - found.get(name, np.zeros(weights.shape))[at_]) < 1e-5, (name, at_)


def corpus(n, seed):
    """Two languages whose words follow their own order."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        lang, k, words = rng.choice("ab"), rng.randrange(8), []
        for _ in range(rng.randint(1, 60)):
            k = (k + rng.choice((1, 1, 1, 2))) % 8
            words.append(f"{lang.upper() if rng.random() < 0.1 else lang}{k}" if rng.random() < 0.9 else f"x{rng.randrange(60)}")
        out.append(" ".join(words))
    return out


def test_counts_are_exact_and_the_model_beats_them(spark):
    texts = [*corpus(400, 5), None, "", " \t\n", "a1", "a1", "y" * 500 + " " + "y" * 500, "z" * 700, "b2 \x0b b3 new " * 2_000]
    df = docs(spark, texts).withColumns({"score": F.lit("clash"), "trains": F.lit("clash")})
    got = {r.doc_id: r for r in recurrent.score_documents(df.repartition(3), fold(F.col("doc_id"), 5) != 1, SMALL).collect()}
    words = [[*WORD.findall(lowered(t or "")), None] for t in texts]
    trains = [zlib.crc32(str(k).encode()) % 5 != 1 for k in range(len(texts))]
    c = Counter(w for k, ws in enumerate(words) if trains[k] for w in ws)
    n, v = sum(c.values()), len(c)
    assert len(got) == len(texts)
    for k, ws in enumerate(words):
        r = got[k]
        assert (r.trains, r.n_tokens, r.n_known, r.train_tokens) == (trains[k], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel_tol=1e-9)
        assert r.score < 0
    held = [k for k in range(400) if not trains[k]]
    per = lambda name: sum(getattr(got[k], name) for k in held) / sum(got[k].n_tokens for k in held)
    assert per("score") > per("base_score") + 0.1
    equal = [k for k, t in enumerate(texts) if t == "a1"]
    assert math.isclose(got[equal[0]].score, got[equal[1]].score, rel_tol=1e-4)


def test_defined_cases(spark):
    df = docs(spark, ["a b", None, "a b"], [None, 4, 4])
    rows = recurrent.score_documents(df, fold(F.col("doc_id"), 5) != 1, SMALL).collect()
    assert len(rows) == 3 and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    none = recurrent.score_documents(df, F.lit(False), SMALL).collect()
    assert {(r.train_tokens, r.n_known) for r in none} == {(0, 0)} and {round(r.base_score, 9) for r in none} == {0.0}
    assert recurrent.score_documents(df.limit(0), F.lit(True), SMALL).count() == 0


def test_most_frequent_words(spark):
    table = spark.createDataFrame([(f"w{k}".encode(), 1 + 4000 // (k + 1)) for k in range(3_000)], "word binary, n long")
    for most in (0, 5, 100, 1_500, 5_000):
        held = sorted((r.n for r in table.where(recurrent.most_frequent(table, most)).collect()), reverse=True)
        assert len(held) <= most and len(held) >= min(3_000, most) * 0.9 - 1
        rest = sorted((1 + 4000 // (k + 1) for k in range(3_000)), reverse=True)[len(held)] if len(held) < 3_000 else 0
        assert not held or held[-1] * 1.05 >= rest / 1.05


def test_models_of_tasks_are_averaged_by_tokens():
    flat = [np.arange(5.0), np.full(5, 2.0)]
    rows = [recurrent.weights_batch({0: x * n}, 0, n) for x, n in zip(flat, (10, 30), strict=True)]
    (out,) = recurrent._summed(iter(rows))
    assert np.allclose(np.frombuffer(out.column(3)[0].as_py()) / out.column(2)[0].as_py(), (flat[0] + 3 * flat[1]) / 4)
    assert isinstance(out, pa.RecordBatch)


def test_many_documents_and_long_ones_by_definition(monkeypatch):
    monkeypatch.setattr(recurrent, "PASS", 64)
    monkeypatch.setattr(recurrent, "CACHED", 7)
    monkeypatch.setattr(recurrent, "TOGETHER", 5)
    m, rng = model(), np.random.default_rng(6)
    sizes = [*rng.integers(0, 30, 23), 200, 0, 1]
    symbols, at = rng.integers(0, 24, sum(sizes)), np.concatenate([[0], np.cumsum(sizes)])
    plain = [plain_likelihood(m, symbols[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert np.allclose(recurrent.likelihoods(m, symbols, at, 8), plain, rtol=1e-5)
    loss = recurrent.learn(m, symbols[:8], np.array([0, 3, 8]), SMALL, recurrent.Descent(m, 0.0))
    assert abs(loss + sum(plain_likelihood(m, symbols[a:b].tolist()) for a, b in ((0, 3), (3, 8))) / 8) < 1e-5


def test_shares_that_vanish():
    weights, bias = np.array([[90.0], [0.0], [-90.0]], np.float32), np.zeros(3, np.float32)
    states = np.array([[1.0], [-1.0], [0.0]], np.float32)
    for at in range(3):
        got = recurrent.log_of(weights, bias, states, *recurrent.shares(weights, bias, states), np.full(3, at))
        x = states.astype(float) @ weights.T.astype(float)
        assert np.allclose(got, x[:, at] - np.log(np.exp(x).sum(axis=1)), rtol=1e-5)


def test_a_step_goes_through_whole_rows():
    """Its numbers of one kind lie together; as a row for each text, it went through a state's few numbers at a time, at a third more CPU."""
    m, rng = recurrent.Model(counts_of(), SMALL), np.random.default_rng(7)
    h, symbols, state = SMALL.state, rng.integers(0, 24, 50), rng.uniform(-1, 1, (SMALL.state, 50)).astype(np.float32)
    found = recurrent.stepped(m, state, np.ascontiguousarray(m.inputs.T).take(symbols, axis=1))
    assert all(x.shape == (h, 50) and x.flags.c_contiguous and x.dtype == np.float32 for x in found)
    given, own = m.inputs[symbols], state.T @ m.recurrent
    r, z = (1 / (1 + np.exp(-(given[:, k * h : (k + 1) * h] + own[:, k * h : (k + 1) * h]))) for k in (0, 1))
    n = np.tanh(given[:, 2 * h :] + r * own[:, 2 * h :])
    assert np.allclose(found[0].T, (1 - z) * n + z * state.T, atol=1e-6)
