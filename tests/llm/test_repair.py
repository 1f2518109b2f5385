"""Conversation repair against a plain search over edits, and its defined cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from eventjobs.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = r"[^\x20\x09-\x0D]"


def plain(turns):
    """The definition over (turn, role, text) in order: the cheapest, then least, of all audits, kept by state as turns come."""
    seen, faults = set(), []
    for _, role, text in turns:
        last = re.findall(WORD, text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    step = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}

    def grown(paths):
        for _ in range(3):
            for state, (cost, audit, out) in list(paths.items()):
                for r, name in (("u", "user"), ("a", "assistant")):
                    if state in step[r]:
                        new = (cost + 5, audit + "I", [*out, f"{name}:"])
                        paths[step[r][state]] = min(paths.get(step[r][state], new), new)
        return paths

    paths = {"": (0, "", [])}
    for (_, role, text), fault in zip(turns, faults, strict=True):
        new = {}

        def put(state, path):
            new[state] = min(new.get(state, path), path)

        for state, (cost, audit, out) in grown(paths).items():
            put(state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault else 0
            for r, name in (("u", "user"), ("a", "assistant")):
                if state in step[r]:
                    put(step[r][state], (cost + 1 + more, audit + "R", [*out, f"{name}:{text}"]))
            if role[:1] in step and state in step[role[:1]]:
                put(step[role[:1]][state], (cost + more, audit + "K", [*out, f"{role}:{text}"]))
        paths = new
    cost, audit, out = min(path for state, path in grown(paths).items() if state in ("", "a"))
    held = sorted({t for t, _, _ in turns if t is not None})
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns[:-1], turns[1:], strict=True))
    return (held[-1] - held[0] + 1 - len(held) if held else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def rows_of(rng, conv_id, n):
    said = ["Yes.", "no", "Why?", " ", "", "ok!\n", "Well. . ", "a b", "é!"]
    return [(conv_id, None if rng.random() < 0.05 else t, rng.choice(["user", "assistant", "system", "tool", "", "user", "assistant"]), rng.choice(said) + (str(rng.randrange(9)) + "." if rng.random() < 0.5 else "")) for t in rng.sample(range(2 * n), n)]


def ordered(rows):
    return sorted(((t, r, x) for _, t, r, x in rows), key=lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.sha256(v[2].encode()).digest()))


@pytest.mark.parametrize("batch", [10_000, 7])
def test_repair_by_its_definition(spark, batch):
    """Also with conversations that many runs share, each as small as a batch."""
    rng = random.Random(3)
    rows = [r for c in range(60) for r in rows_of(rng, c, rng.randint(1, 9))] + rows_of(rng, 99, 700)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {c: plain(ordered([r for r in rows if r[0] == c])) for c in got} and len(got) == 61


def test_rules_stand_for_the_same_turns():
    rng = np.random.default_rng(4)
    motif = rng.integers(0, 16, 12)
    parts = [np.concatenate([motif, rng.integers(0, 16, 3), motif]) for _ in range(30)] + [np.full(9, 5), np.zeros(0, dtype=np.int64)]
    at = np.concatenate([[0], np.cumsum([p.size for p in parts])])
    symbols, ends, rules = repair.repair_grammar(np.concatenate(parts), at, 16)

    def full(s):
        return [s] if s < 16 else full(rules[s - 16][0]) + full(rules[s - 16][1])

    for p, a, b in zip(parts, ends[:-1], ends[1:], strict=True):
        assert [x for s in symbols[a:b].tolist() for x in full(s)] == p.tolist()
    assert symbols.size < at[-1] / 3 and len(rules) > 5


def test_ropes_compare_like_their_texts():
    rng = random.Random(5)
    ropes = [repair.Rope(None, None, x) for x in ("D", "K", "R", "I")]
    for _ in range(200):
        ropes.append(repair.joined(rng.choice(ropes), rng.choice(ropes)))
        if ropes[-1].size > 200:
            ropes.pop()
    for _ in range(2_000):
        a, b = rng.choice(ropes), rng.choice(ropes)
        assert repair.less(a, b) == (str(a) < str(b))


def test_damage_and_defined_cases(spark):
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("system", "Be kind."), ("user", "Hi. There?"), ("assistant", None), ("user", "Bye!"), (None, "Ok.")])]
    rows += [(None, None, None, None), (7_000_000, 1, "user", "long. " * 200_000), *[(500, 3, "user", "same.")] * 400]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'clash' as audit", "1 as cost")
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_damaged(df).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        kept = []
        for _, t, r, x in (r for r in rows if r[0] == c):
            what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            r, x = " " if r is None else r, " " if x is None else x
            if what:
                x = "" if what == 1 else re.sub("[.!?]", "", x) if what == 2 else x
                kept += [(c, t, "user" if what == 4 else r, x)] * (2 if what == 3 else 1)
        want[c] = plain(ordered(kept))
    assert got == want
    assert repair.repair_damaged(df.limit(0)).count() == 0
    copies = 3 * repair.GATHERED + 5  # more copies of one turn than a batch may hold
    many = spark.range(copies).selectExpr("1L as conv_id", "2L as turn", "'user' as role", "'x.' as text")
    (one,) = repair.repair(many).collect()
    assert (one.duplicate, one.illegal, one.cost, len(one.audit)) == (copies - 1, copies - 1, 2 * copies, copies)
