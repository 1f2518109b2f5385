"""The operators against brute force on small tables, and their defined cases."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventjobs.llm import chat_format as chat
from eventjobs.llm import decontaminate, labelled, minhash_dedup, packing, quality, substring_dedup, topk, toxicity, url_filter
from eventjobs.llm.shared import Words, bitmap, in_bitmap

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None, None) for i, t in zip(ids, texts, strict=True)], DOCS)


def corpus(n=60, seed=1):
    """Texts of a few families: bases, edited copies, shared passages, exact copies, edge cases."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=45))
    out = []
    for k in range(n):
        words = rng.choices(vocabulary, k=rng.randint(1, 160))
        if k % 5 == 1 and out:
            words = (out[-1] or "x").split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if k % 7 == 3:
            words[len(words) // 2 : len(words) // 2] = passage.split()
        out.append(" ".join(words))
    return [*out, None, "", " \t\n", out[0], out[0].upper(), "a b", "a  b", "é Ünï\x0bx", "same " * 70]


def test_words_are_the_regular_expressions():
    texts = ["a  b\x0bc", "", " x", "\x1c y\x85z é", "a b  "]
    words = Words([t.encode() for t in texts])
    got = [[words.raw[words.starts[k] : words.ends[k]].decode() for k in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    assert got == [WORD.findall(t) for t in texts]
    same = Words([b"x yy", b"zzz yy x"]).hashes
    assert same[0] == same[4] and same[1] == same[3] and len(set(same.tolist())) == 3


def test_words_lose_all_marks_around_them():
    texts = [b"word!!!!!!!", b"*******word*******", b"word", b"wo--rd ========== x"]
    codes = decontaminate.Template(texts).codes
    assert codes[0] == codes[1] == codes[2] and codes.size == 5
    own = toxicity.Tokens(texts, toxicity.Params())
    assert own.features[0, 0] == own.features[1, 0] == own.features[2, 0]


def brute_components(texts, ids, n):
    sets = {}
    for i, t in zip(ids, texts, strict=True):
        w = WORD.findall(lowered(t or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    low = {i: i for i in ids}

    def root(x):
        while low[x] != x:
            x = low[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                low[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def test_near_duplicates(spark):
    texts = corpus()
    got = minhash_dedup.near_duplicates(docs(spark, texts), minhash_dedup.Params(shingle=4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_components(texts, range(len(texts)), 4)


def test_near_duplicates_of_a_large_group(spark):
    """A group larger than many leaves, with outsiders near its edge: nothing is lost to the blocks."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(260):
        words = list(base)
        for _ in range(rng.randint(0, 2) if k % 9 else 5):
            words[rng.randrange(60)] = f"v{rng.randrange(30)}"
        texts.append(" ".join(words))
    p = minhash_dedup.Params(shingle=2, leaf=16, depth=4)
    got = minhash_dedup.near_duplicates(docs(spark, texts), p).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute_components(texts, range(len(texts)), 2)


def test_recall_of_pairs_at_the_threshold_in_nodes_that_branch_to_the_end():
    """Signatures of pairs at 0.8 go down all levels of all trees, as they do inside a large group of boilerplate."""
    p, n, rng = minhash_dedup.Params(), 4_000, np.random.default_rng(3)
    left = rng.integers(0, 1 << 32, size=(n, p.positions), dtype=np.uint32)
    equal = rng.random(left.shape) < p.similarity
    right = np.where(equal, left, left + np.uint32(1))
    all_bits = np.full(16, np.uint64(0xFFFFFFFFFFFFFFFF))

    size = (1000).to_bytes(4, "little")

    def held(side):
        batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array([size + x.tobytes() for x in side])], names=["node", "component", "signature"])
        return [b for b in minhash_dedup._entries(iter([batch]), p, list(range(p.trees)), p.two, [all_bits] * ((p.depth - 1) // p.stride), None)]

    met = np.zeros(n, dtype=bool)
    for a, b in zip(held(left), held(right), strict=True):
        keys = [set(zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True)) for x in (a, b)]
        met[[node for _, node in keys[0] & keys[1]]] = True
    sketches = [[size + x.tobytes() for x in side.astype(np.uint8)] for side in (left, right)]
    near = [bool(list(minhash_dedup.Sketches(list(both), p).near(0, 2, np.arange(2)))) for both in zip(*sketches, strict=True)]
    assert (met & near).mean() >= p.recall - 3 * (0.001 / n) ** 0.5


def test_recall_of_documents_at_the_threshold(spark):
    """Separate pairs of texts at a similarity of 0.80 to 0.82, brute force says which: the share that is linked."""
    rng, texts = random.Random(8), []
    for _ in range(1500):
        words = [f"w{rng.randrange(1 << 30)}" for _ in range(rng.randint(91, 96))]
        texts += [" ".join(words), " ".join([*words[:-10], *(f"v{rng.randrange(1 << 30)}" for _ in range(10))])]
    p = minhash_dedup.Params(shingle=1)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs(spark, texts), p).collect()}
    near = [k for k in range(0, len(texts), 2) if 100 * len(set(texts[k].split()) & set(texts[k + 1].split())) >= 80 * len(set(texts[k].split()) | set(texts[k + 1].split()))]
    assert len(near) > 1000
    assert sum(got[k + 1] == k for k in near) / len(near) >= p.recall - 3 * (0.001 / len(near)) ** 0.5


def test_near_duplicates_edges(spark):
    df = docs(spark, ["a b c d e", "a b c d e", None, "a b c d e"], [3, None, 7, 3])
    got = minhash_dedup.near_duplicates(df).orderBy("doc_id", "n_shingles").collect()
    assert [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got] == [(None, 1, None, True), (3, 1, 3, True), (3, 1, 3, True), (7, 0, 7, True)]
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.normal(0, 0.1, 8)]) for k in range(120)]
    rows += [(200, rows[0][1]), (201, None), (202, [float("nan")] * 8), (203, [None] + [0.0] * 7), (204, [1.0]), (205, []), (None, rows[1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, 5).collect()
    held = {r.vec_id: list(r.v) for r in df.collect() if r.v is not None and r.vec_id is not None}
    want = []
    for q in [x for x in held if x % 20 == 0]:
        scored = sorted((-sum(a * b for a, b in zip(held[q], v)), i) for i, v in held.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)
    found = spark.createDataFrame(want, "query_id long, rank int, vec_id long, score long")
    assert topk.recall(found, found) == 1.0 and topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_index_stops_only_on_proof():
    rng = np.random.default_rng(0)
    vectors = np.concatenate([rng.integers(-60, 60, (900, 16)), np.repeat(rng.integers(-200, 200, (1, 16)), 30, axis=0)])
    queries = np.concatenate([vectors[:20], vectors[-2:], np.zeros((1, 16), dtype=np.int64)])
    index, shares = topk.ShardIndex(vectors), []
    for q in queries:
        rows, read = index.possible(q, 6)
        scores = vectors @ q
        assert set(np.flatnonzero(scores >= np.sort(scores)[-6])) <= set(rows.tolist())
        shares.append(read / index.sizes.sum())
    # Each query stops by itself: those near the planted group early, the one of zeros before it reads anything.
    assert max(shares[20:22]) < 0.8 and shares[22] == 0 and len(set(shares)) > 2


def test_quality_and_toxicity_hold_out(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdeghik", k=rng.randint(2, 7))) for _ in range(300)]
    texts, good, toxic = [], [], []
    for k in range(500):
        words = rng.choices(vocabulary, k=rng.randint(20, 80))
        good.append(int(k % 4 != 0))
        toxic.append(int(k % 3 == 0))
        if not good[-1]:
            words = [w + "!!" for w in words]
        if toxic[-1]:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(("zorgax", "Zorgun,", "vixxo", "vixxen.")))
        texts.append(" ".join(words))
    df = docs(spark, [*texts, None, ""])
    labels = spark.createDataFrame([(k, g, t) for k, (g, t) in enumerate(zip(good, toxic, strict=True))] + [(None, 1, 1), (3, None, 9)], "doc_id long, quality int, toxic int")
    p = quality.Params(each=200)
    sample = labelled.sample(df, labels, "quality", labelled.fold(F.col("doc_id"), 4) != 2, p.each)
    assert len(sample) <= 400 and set(sample.label) == {0, 1}
    scored = quality.score_quality(df, quality.train(sample, p), p).collect()
    held = [r for r in scored if r.doc_id < 500 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([(r.score >= 0.7) == bool(good[r.doc_id]) for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in scored)
    assert [r.score for r in scored if r.doc_id == 500] == [r.score for r in scored if r.doc_id == 501]
    tp = toxicity.Params(each=200)
    model = toxicity.train(labelled.sample(df, labels, "toxic", labelled.fold(F.col("doc_id"), 5) != 0, tp.each), tp)
    scored = toxicity.score_toxicity(df, model, tp).collect()
    held = [r for r in scored if r.doc_id < 500 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == bool(toxic[r.doc_id]) for r in held]) > 0.97
    spans = {r.text[s.start : s.start + s.length].lower() for r in held if toxic[r.doc_id] for s in r.spans}
    assert {"zorgax", "vixxo"} <= spans
    none = pd.DataFrame({"text": [], "label": []})
    assert quality.score_quality(df.limit(1), quality.train(none, p), p).first().score == 0.5 and toxicity.score_toxicity(df.limit(1), toxicity.train(none, tp), tp).first().score == 0.5


def test_marginals_are_the_whole_chains():
    rng = np.random.default_rng(0)
    scores, moves, first = rng.normal(0, 2, 300), rng.normal(0, 1, (2, 2)), np.array([0, 0, 130, 131, 300])
    got = toxicity.marginals(scores, moves, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        forward, state = [], np.array([0.5, 0.5])
        for t in range(a, b):
            state = (state @ np.exp(moves)) * np.array([1, np.exp(scores[t])])
            state /= state.sum()
            forward.append(state)
        back = np.ones(2)
        for t in reversed(range(a, b)):
            both = forward[t - a] * back
            assert got[t] == pytest.approx(both[1] / both.sum())
            back = np.exp(moves) @ (np.array([1, np.exp(scores[t])]) * back)
            back /= back.sum()


def test_slopes_are_those_of_the_likelihood():
    """Against the likelihood summed over all paths of states, by finite differences; texts of no, one and more tokens."""
    import itertools

    rng = np.random.default_rng(1)
    first, features = np.array([0, 4, 4, 5, 9]), rng.integers(0, 6, size=(9, 2))
    y, weights, moves = rng.integers(0, 2, 9).astype(float), rng.normal(0, 1, 6), rng.normal(0, 1, (2, 2))

    def loss(w, m):
        out = 0.0
        for a, b in zip(first[:-1], first[1:], strict=True):
            scores = w[features[a:b]].sum(axis=1)
            value = lambda path: sum(s * z for s, z in zip(path, scores, strict=True)) + sum(m[i, j] for i, j in itertools.pairwise(path))  # noqa: B023, E731
            # Before a text's first token stands either state, with the same weight.
            start = lambda path: np.log(np.exp(m[:, path[0]]).sum()) if path else 0.0
            out += np.logaddexp.reduce([value(q) + start(q) for q in itertools.product((0, 1), repeat=b - a)]) - value(tuple(y[a:b].astype(int))) - start(tuple(y[a:b].astype(int)))
        return out

    slope, _ = toxicity.slopes(weights, moves, features, y, first)
    step = 1e-6
    for k in range(6):
        w = weights.copy()
        w[k] += step
        assert (loss(w, moves) - loss(weights, moves)) / step == pytest.approx(slope[k], abs=1e-3)


def test_toxicity_on_given_labels():
    """Held-out rows of the given tables, which mark insults and, in three languages, stems in many forms."""
    import duckdb

    d = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"select d.doc_id, coalesce(text, ''), toxic from '{d}/documents.parquet' d join '{d}/labels.parquet' l using (doc_id) where toxic in (0, 1) order by doc_id").fetchall()
    held, seen = ([r for r in rows if (zlib.crc32(str(r[0]).encode()) % 5 == 0) == x] for x in (True, False))
    p = toxicity.Params()
    model = toxicity.train(pd.DataFrame({"text": [r[1] for r in seen if r[2]] + [r[1] for r in seen if not r[2]][:2000], "label": [1] * sum(r[2] for r in seen) + [0] * min(2000, sum(not r[2] for r in seen))}), p)
    said = np.array(toxicity.scored([r[1].encode() for r in held], model, p, False).field(0)) >= 0.5
    true = np.array([r[2] == 1 for r in held])
    assert (said & true).sum() >= 0.88 * true.sum() and (said & true).sum() >= 0.9 * said.sum()


def test_quality_by_its_definition():
    """Features, mean, softmax and every step of the descent once more, with dictionaries and loops."""
    texts, labels = ["aa bb aa", "aa aa", "", "x bb\ty é", "bb"], [1, 0, 0, 1, 1]
    p = quality.Params(buckets=1 << 10, dims=3, epochs=2)
    words = lambda t: Words([t]).hashes
    fold = lambda h: int(h >> np.uint64(40)) & (p.buckets - 1)

    def buckets(text):
        h = words(text.encode())
        out = [fold(x) for x in h]
        for x, y in zip(h[:-1], h[1:], strict=True):
            out.append(fold(np.uint64(0x1234567890ABCDEF) if x == y else minhash_dedup.mix(np.array([x * np.uint64(3) + y]))[0]))
        raw = text.encode()
        for n in p.grams:
            out += [fold(minhash_dedup.mix(np.array([int.from_bytes(raw[k : k + n], "big") * (2 * n + 1)], dtype=np.uint64))[0]) for k in range(len(raw) - n + 1)]
        return out

    found, at = quality.features([t.encode() for t in texts], p)
    assert [sorted(found[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)] == [sorted(buckets(t)) for t in texts]
    rng = np.random.default_rng(p.seed)
    v = rng.normal(0, 0.1, (p.buckets, p.dims)).astype(np.float32).astype(float)
    out, bias, done, balance = np.zeros((2, p.dims)), np.zeros(2), 0, [0.5 / 0.4, 0.5 / 0.6]
    for _ in range(p.epochs):
        for k in rng.permutation(len(texts)):
            own = buckets(texts[k])
            mean = sum((v[b] for b in own), np.zeros(p.dims)) / max(1, len(own))
            e = np.exp(out @ mean + bias)
            wrong = (e / e.sum() - np.eye(2)[labels[k]]) * (p.rate * (1 - done / 10) + 0.01) * balance[labels[k]]
            for b in set(own):
                v[b] -= own.count(b) / len(own) * 200 * (wrong @ out)
            out, bias, done = out - np.outer(wrong, mean), bias - wrong, done + 1
    table, offset = quality.train(pd.DataFrame({"text": texts, "label": labels}), p)
    assert table == pytest.approx(v @ (out[1] - out[0]), abs=1e-3) and offset == pytest.approx(bias[1] - bias[0], abs=1e-4)
    own = buckets(texts[0])
    assert quality.scores([texts[0].encode()], table, offset, p)[0] == pytest.approx(1 / (1 + np.exp(-np.mean(table[own]) - offset)))


def test_classifiers_defined_cases(spark):
    """Repeated rows, clashing names, very long and empty texts, an empty table."""
    p, tp = quality.Params(), toxicity.Params()
    table, model = (np.linspace(-1, 1, p.buckets).astype(np.float32), 0.1), toxicity.Model(np.linspace(-1, 1, tp.buckets))
    df = docs(spark, ["a b", "a b", "", None, "very long " * 200_000], [1, 1, 2, None, 3]).withColumns({"score": F.lit("x"), "spans": F.lit("y")})
    good, bad = quality.score_quality(df, table, p), toxicity.score_toxicity(df, model, tp)
    assert set(good.columns) == set(df.columns) == set(bad.columns)
    for rows in (good.collect(), bad.collect()):
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows) and len({r.score for r in rows if r.doc_id == 1}) == 1
    assert quality.score_quality(df.limit(0), table, p).count() == 0 == toxicity.score_toxicity(df.limit(0), model, tp).count()


ITEM = "If Tom has 5 apples and Ann has 7 kg of apples then Tom gives 5 apples to Ann."


def test_decontamination(spark):
    texts = ["before it. " + ITEM + " after it", "Well, if Bob has 9 apples and Eve has 4 kg of apples then Bob gives 9 apples to Eve. ok",
             "if Bob has 9 apples and Eve has 4 kg of apples then Eve gives 2 apples to Eve", "if tom has apples", None, "", "x a b c y"]
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "a b c"), (4, "")], "item_id long, text string")
    df = docs(spark, texts).withColumn("item_id", F.lit("clash"))
    got = {r.doc_id: (r.contaminated, r.item_id, r.matched_tokens) for r in decontaminate.judge_contamination(df, bench).collect()}
    assert got == {0: (True, 1, 19), 1: (True, 1, 19), 2: (False, None, 0), 3: (False, None, 0), 4: (False, None, 0), 5: (False, None, 0), 6: (True, 3, 3)}
    assert sorted(r.doc_id for r in decontaminate.clean_documents(df, bench).collect()) == [2, 3, 4, 5]
    assert decontaminate.clean_documents(df, bench.limit(0)).count() == 7 and decontaminate.clean_documents(df.limit(0), bench).count() == 0


def verdicts(spark, texts, items):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {r.doc_id: r.item_id for r in decontaminate.judge_contamination(docs(spark, texts), bench).collect() if r.contaminated}


def test_contamination_by_items_of_few_words(spark):
    items = ["What is 3 + 4 * 5 - 6", "Convert 5 km 3 m 20 cm to mm", "guests: Ann Bob Cid Dan Eve Fay Gus Hal Ida Jon Kit Lea", "7 13 21 34 55 89 144 233 377 610 987 1597 2584 4181"]
    texts = [f"so it began.\n{x}\nand it went on" for x in items]
    texts += ["so.\nWhat is 1 + 2 * 7 - 9\nand on", "so.\nguests: Tim Ann Bob Cid Dan Eve Una Vic Wes Xan Yul Zoe\nand on", "so.\n7 13 21 34 55 89 145 233 377 610 987 1597 2584 4181\nand on"]
    assert verdicts(spark, texts, items) == {0: 0, 1: 1, 2: 2, 3: 3}


def test_contamination_by_a_run_of_equal_values(spark):
    item = "if Tom has 5 apples and Ann has 7 kg of pears then Tom gives some of his 5 apples to Ann and she bakes them into a cake for the fair"
    texts = [f"x. {item} y", f"x. {item.replace('his 5', 'his 6')} y", "x. if Bob has 9 apples and Eve has 4 kg of pears then Tom gives some of his 5 apples to Eve and she ran"]
    assert verdicts(spark, texts, [item]) == {0: 0, 1: 0}


def test_contamination_wherever_an_item_stands(spark):
    items = ["Which river flows through the old town of Ulm", "Where did Mary and John Smith meet. They met in Rome on a very warm day", "Name one king of France"]
    texts = [f"they asked me, {x}, and went on" for x in items] + [f"they asked: {x.lower()}; and went on" for x in items] + [f"they asked ({x.upper()}) and went on" for x in items]
    texts += ["so\n" + items[1].replace(" ", "\n") + "\nso", "so. " + items[0].replace("Which river", "which river") + " so", "they asked me, Their river flows through the old town of", "they asked me, Give one king of France so"]
    assert verdicts(spark, texts, items) == {k: k % 3 for k in range(9)} | {9: 1, 10: 0}


def test_exact_benchmark_passages(spark):
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(500)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(9, 40))) for _ in range(20)]
    texts = []
    for k in range(80):
        words = rng.choices(vocabulary, k=rng.randint(5, 200))
        if k % 3 == 0:
            words[len(words) // 2 : len(words) // 2] = items[k % 20].split()
        texts.append(" ".join(words))
    got = {r.doc_id for r in decontaminate.judge_contamination(docs(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect() if r.contaminated}
    assert got == {k for k, t in enumerate(texts) if any(f" {i} " in f" {t} " for i in items)}


def test_chat_formats(spark):
    rows = ['{"messages":[{"role":"user","content":"a<|end|>&lt;"},{"role":"assistant","content":null}]}', '{"prompt":"p","response":"r","system":null}', '{"instruction":"i","input":"k","output":"o","meta":{"z":[1,2]}}', "bad", None, '{"conversations":[{"from":"human","value":"[INST]"},{"from":"g|>pt","value":"é\\n"}]}', '{"question":"q","answer":"a","system":"s"}']
    out = chat.format_chats(spark.createDataFrame([(k, r, "x") for k, r in enumerate(rows)], "k long, record string, layout string")).withColumn("back", chat.read_back(F.col("formatted"))).orderBy("k").collect()
    assert [r.layout for r in out] == ["messages", "prompt", "instruction", "unknown", "unknown", "conversations", "question"]
    assert all([(t.role, t.text) for t in r.back] == [(t.role, t.text) for t in r.turns] for r in out)
    assert [(t.role, t.text) for t in out[5].turns] == [("user", "[INST]"), ("g|>pt", "é\n")]
    assert len({r.fingerprint for r in out}) == 6 and out[3].fingerprint == out[4].fingerprint
    for r in out:
        assert [r.formatted[s.start : s.start + s.length] for s in r.loss_spans] == [t.text for t in r.turns if t.role == "assistant"]


def test_fingerprints_select_the_mapping(spark):
    """The same paths under another name in the map give another layout; paths that no mapping names change nothing."""
    rows = ['{"prompt":"p","response":"r"}', '{"response":"r","x":{"y":1},"prompt":"p"}', '{"prompt":"p","response":"r","question":"q"}', '{"prompt":"p"}']
    df = spark.createDataFrame([(r,) for r in rows], "record string")
    out = chat.canonical(df).collect()
    assert [r.layout for r in out] == ["prompt", "prompt", "unknown", "unknown"] and out[0].fingerprint == out[1].fingerprint
    other = (chat.Mapping("turned", ("prompt", "response"), fields=(("assistant", "prompt"), ("user", "response"))),)
    assert [[(t.role, t.text) for t in r.turns] for r in chat.canonical(df, mappings=other).collect()][0] == [("assistant", "p"), ("user", "r")]
    native = chat.canonical(df.select(F.struct(F.lit("p").alias("prompt"), F.lit(None).cast("string").alias("response")).alias("record"))).first()
    assert native.fingerprint == out[0].fingerprint and [(t.role, t.text) for t in native.turns] == [("user", "p"), ("assistant", "")]


def test_turn_order(spark):
    turns = spark.createDataFrame([(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, None, "system", None), (1, 1, "user", "a"), (None, 1, None, "z")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.format_chats(chat.records_of_turns(turns)).collect()}
    assert got == {1: [("system", ""), ("user", "a"), ("user", "a"), ("assistant", "b")], None: [("", "z")]}
    assert chat.format_chats(chat.records_of_turns(turns.limit(0))).count() == 0


def test_turns_of_any_length(spark):
    """A text longer than a JSON reader takes."""
    turns = spark.range(1).select(F.lit(1).alias("conv_id"), F.lit(1).alias("turn"), F.lit("assistant").alias("role"), F.repeat(F.lit("<ab"), 7_000_001).alias("text"))
    out = chat.format_chats(chat.records_of_turns(turns)).select("layout", F.length(chat.read_back(F.col("formatted"))[0]["text"]).alias("n"), F.size("loss_spans").alias("spans")).first()
    assert (out.layout, out.n, out.spans) == ("messages", 21_000_003, 1)


def brute_repeats(rows, n):
    first = {}
    for i, w in sorted(rows, key=lambda x: x[0]):
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for i, w in rows:
        gone = {j for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < (i, k) for j in range(k, k + n)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substring_dedup(spark):
    texts = [*corpus(), "one two " * 40, "x " + "one two " * 30 + "y"]
    ids = list(range(len(texts)))
    ids[4], ids[9] = ids[3], ids[8]  # repeated ids
    df = docs(spark, texts, ids).withColumn("n_words", F.lit("clash"))
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(df).collect())
    assert got == brute_repeats([(i, WORD.findall(t or "")) for i, t in zip(ids, texts, strict=True)], 20)
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0
    null = substring_dedup.remove_repeats(docs(spark, [texts[0], texts[0]], [None, 5])).collect()
    assert {r.doc_id: r.n_removed > 0 for r in null} == {None: False, 5: len(texts[0].split()) >= 20}


def test_what_a_text_repeats_in_itself_is_one_span(spark):
    """Paths that their own text holds earlier join nothing: a few spans stand for thousands of windows, with the same result."""
    said, rng = "w " * 3000, random.Random(8)
    assert substring_dedup.repeated_spans(docs(spark, [said, said, "a b c " * 900])).count() <= 6
    line, words = " ".join(f"l{k}" for k in range(30)), [f"v{k}" for k in range(40)]
    parts = lambda: rng.choice(["w " * rng.randint(5, 60), "a b " * rng.randint(5, 40), line + " ", " ".join(rng.choices(words, k=25)) + " ", line[:70] + " "])
    texts = [said, "x " + said + "y " + said, *("".join(parts() for _ in range(rng.randint(1, 12))) for _ in range(80))]
    ids = list(range(len(texts)))
    ids[5], ids[9] = ids[4], ids[8]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs(spark, texts, ids)).collect())
    assert got == brute_repeats([(i, WORD.findall(t)) for i, t in zip(ids, texts, strict=True)], 20)


@pytest.fixture(scope="module")
def params():
    import public_tokenizers

    return packing.Params(tokenizer=public_tokenizers.path("byte_bpe_50k.json"), capacity=64, gathered=2000)


EDGE = ["", " a", "a  b", "a \n b", "\n\na b", "it's we'll  ", "a <|endoftext|> b", "中文 字", "a\n", "\ta b\n\n c", "é è\r\n ab", "a 'll", "​ x", "a b", "\nx"]


def ids_of(params, text):
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(params.tokenizer).encode(text or "", add_special_tokens=False).ids, 1]


def test_token_ids_keep_nothing_between_texts(params):
    """Any mixture of pieces has the tokenizer's ids; no table of pieces is filled, which has to be let go and made anew."""
    import tracemalloc

    from eventjobs.llm.tokens import encoder

    rng, encode = random.Random(3), encoder(params.tokenizer)
    texts = [rng.choice(("", " ", "\n")) + "".join(rng.choice(("a", "é", "'s", "中", "b2", "<|endoftext|>"[: rng.choice((3, 13))])) * rng.randint(1, 2) + rng.choice((" ", "\n", " ", "\n", "")) for _ in range(rng.randint(0, 9))) for _ in range(500)]
    texts += [f"\n{t.strip()}" for t in texts[:200]] + EDGE
    assert [x.tolist() for x in encode.ids(texts)] == [encode.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert encode.ids([]) == [] and [x.tolist() for x in encode.ids(["", ""])] == [[], []]
    tracemalloc.start()
    encode.ids([" ".join(f"n{k}x{j}" for j in range(200)) for k in range(200)])
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 1_000_000


def test_harmonic_packing(spark, params):
    texts = [*corpus(40), *EDGE]
    rows = packing.pack_harmonic(docs(spark, texts).repartition(3), params).collect()
    want = {k: ids_of(params, t) for k, t in enumerate(texts)}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == want[r.doc_id][r.start : r.start + r.length] and zlib.crc32(r.ids) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for k, ids in want.items():
        ends = [0, *(a + n for a, n in sorted(pieces[k]))]
        assert [a for a, _ in sorted(pieces[k])] == ends[:-1] and ends[-1] == len(ids)
    padding = 0
    for own in sequences.values():
        ends = [0, *(a + n for a, n in sorted(own))]
        assert [a for a, _ in sorted(own)] == ends[:-1] and ends[-1] <= 64
        padding += 0 if ends[-1] & ends[-1] - 1 == 0 else 64 - ends[-1]
    assert padding < 0.05 * sum(map(len, want.values())) and packing.pack_harmonic(docs(spark, []), params).count() == 0
    twice = packing.pack_harmonic(docs(spark, ["a b", "a b", "c"], [None, None, 3]), params).collect()
    assert {x: sum(r.length for r in twice if r.doc_id == x) for x in (None, 3)} == {None: 6, 3: 2}


def test_harmonic_bins_hold_whole_documents_of_one_class(params):
    """A bin is k rests of class k and, where they leave room, ids of few other documents; most rests are never cut."""
    from dataclasses import replace

    rng = random.Random(4)
    texts = [" ".join(["a"] * rng.choice((rng.randint(1, 62), rng.randint(20, 40), rng.randint(64, 400)))) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(600)), pa.array(texts)], names=["doc_id", "text"])
    rows = [r for b in packing._harmonic(iter([batch]), replace(params, waiting=8), True) for r in b.to_pylist()]
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
    whole = [r for r in rows if r["start"] + r["length"] == r["doc_tokens"] and r["length"] < 64]
    assert sum(r["start"] == 0 for r in whole) > 0.6 * sum(len(t.split()) < 63 for t in texts)
    assert sum(sum(r["length"] for r in own) == 64 for own in sequences.values()) >= len(sequences) - 7
    alike = 0
    for own in list(sequences.values()):
        first = 64 // own[0]["length"]
        alike += own[0]["length"] == 64 or sum(64 // r["length"] == first for r in own) >= first
    assert alike > 0.9 * len(sequences)


def test_best_fit_packing(spark, params):
    texts = [*corpus(40), *EDGE]
    want = {k: ids_of(params, t) for k, t in enumerate(texts)}
    got = defaultdict(list)
    for r in packing.pack_best_fit(docs(spark, texts).repartition(2), params).collect():
        ids, places = np.frombuffer(r.input_ids, "<u2").tolist(), np.frombuffer(r.position_ids, "<u4").tolist()
        assert len(ids) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64
        for k, (a, b) in enumerate(zip(r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True)):
            assert places[a:b] == list(range(b - a))
            got[r.doc_ids[k]].append((r.doc_starts[k], ids[a:b]))
    assert {k: [x for _, part in sorted(v) for x in part] for k, v in got.items()} == want


def test_best_fit_is_best_fit():
    rng = random.Random(2)
    lengths = [rng.randint(1, 40) for _ in range(300)]
    free, bins = [], []
    for k in sorted(range(300), key=lambda k: (-lengths[k], k)):
        fits = [(f, j) for j, f in enumerate(free) if f >= lengths[k]]
        if fits:
            j = min(fits)[1]
        else:
            j = len(free)
            free.append(40)
            bins.append([])
        free[j] -= lengths[k]
        bins[j].append(k)
    got = packing.best_fit_decreasing(lengths, 40)
    assert len(got) == len(bins) and sorted(x for b in got for x in b) == list(range(300)) and all(sum(lengths[x] for x in b) <= 40 for b in got)


def test_url_filter(spark):
    urls = ["http://A.Example.COM/en/701?x", "https://com/en/", "http://xcom/en/1", "HTTP://b.net/de/9#t", "x.example.net://example.net/de/8", "nourl", None, "", "http://a.org", "http://a.org/es/\n", "http://com/en/1", "http://com/en/1"]
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"), ("org", "/es/", "block"), (None, "/", "block")]
    rng = random.Random(1)
    rules += [(f"h{k}.org", f"/p{k}", "block") for k in range(200)]
    urls += [f"http://{rng.choice(('', 'w.', 'xh'))}h{rng.randrange(250)}.org/p{rng.randrange(250)}" for _ in range(300)]
    df = spark.createDataFrame([(k % 305, u) for k, u in enumerate(urls)], "page_id long, url string")
    got = url_filter.judge_urls(df, spark.createDataFrame(rules, "host string, path string, action string")).collect()

    def judge(u):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (lowered(m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, a) for h, p, a in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, *((max(fits)[1], max(fits)[2]) if fits else (None, "allow"))

    assert sorted((r.page_id, str(r.url), r.host, r.path, str(r.rule), r.verdict) for r in got) == sorted((k % 305, str(u), judge(u)[0], judge(u)[1], str(judge(u)[2]), judge(u)[3]) for k, u in enumerate(urls))
    assert {r.verdict for r in url_filter.judge_urls(df, spark.createDataFrame([], "host string, path string, action string")).collect()} == {"allow"}


def test_bitmap(spark):
    bits = bitmap(spark.range(0, 1000, 7).withColumn("h", F.xxhash64("id")), "h", 1 << 12)
    held = np.array([r.h for r in spark.range(0, 1000, 7).select(F.xxhash64("id").alias("h")).collect()])
    assert in_bitmap(bits, held).all() and bits.size == 64 and in_bitmap(bits, np.arange(4096)).mean() < 0.06


def test_a_full_bitmap_is_small_on_the_driver(spark):
    hashes = spark.range(1_500_000).select(F.xxhash64("id").alias("h"))
    bitmap(hashes.limit(9), "h")
    tracemalloc.start()
    try:
        bits = bitmap(hashes, "h")
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.count_nonzero(bits) > 250_000 and most < 5 * bits.nbytes
