"""Similar titles and placement against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventjobs.functions import ratio
from eventjobs.operators import alike, resolve
from tests.test_operators import REGS, listings, registry

WORDS = ["harvest", "harvests", "fest", "festival", "winter", "fair", "fairs", "market", "night", "nite", "a", "bingo", "zoo"]


def rows_of(n, seed, days=8):
    rng = random.Random(seed)
    return [
        dict(source_id=rng.choice("abcde"), title=" ".join(rng.choices(WORDS, k=rng.randint(0, 4))), start_at=datetime(2026, 11, rng.randint(1, days), rng.choice((10, 19))), city=rng.choice(("", "Duluth", "Ely")),
             venue=rng.choice(("", "Hall", "Old Park", "City Hall")), inferred=rng.random() < 0.2)
        for _ in range(n)
    ]


def plain(text):
    return "".join(x for x in (text or "").lower() if x.isascii() and (x.isalnum() or x == " ")).strip()


def test_similar_titles_of_days(spark, monkeypatch):
    monkeypatch.setattr(alike, "BLOCK", 7)  # crowded days are dealt into blocks
    rows = rows_of(150, 1)
    df = listings(spark, *rows)
    names = {r.id: r.words for r in alike.title_days(df).collect()}
    near, good = alike.similar_days(df, 78)
    got = [(r.day_a, names[r.id_a], r.day_b, names[r.id_b]) for r in near.collect()]
    held = sorted({(r["start_at"].date(), " ".join(sorted(set(plain(r["title"]).split())))) for r in rows if plain(r["title"])})
    want = set()
    for d, a in held:
        for e, b in held:
            if a != b and e - d in (timedelta(0), timedelta(1)) and ratio.token_set(a, b) >= 78:
                want.add((d, a, e, b) if d < e else (d, *sorted((a, b))))
    assert {(d, a, e, b) if d < e else (d, *sorted((a, b))) for d, a, e, b in got} == want and len(got) == len(want) and good.count() > 0


def sequential(rows, high, last=lambda k: k):
    """The definition: one listing after another, each to the first cluster that takes it."""
    rich = lambda r: sum(bool(r.get(k)) for k in ("description", "venue", "image", "price", "end_at"))
    order = sorted(range(len(rows)), key=lambda k: (rows[k]["start_at"], not high.get(rows[k]["source_id"], False), rows[k]["inferred"], -rich(rows[k]), last(k)))
    by_day, out = {}, {}
    for k in order:
        r = rows[k]
        taken = None
        for slack in (1, 0):
            for c in by_day.get(r["start_at"].date() - timedelta(slack), ()):
                if taken or not plain(r["title"]) or not plain(c["title"]):
                    continue
                if any(s == r["source_id"] and t != r["start_at"] for s, t in c["listings"]) and (r["source_id"], r["start_at"]) not in c["listings"]:
                    continue
                if ratio.token_set(plain(c["title"]), plain(r["title"])) < 78:
                    continue
                one, two, v, w = plain(c["city"]), plain(r["city"]), plain(c["venue"]), plain(r["venue"])
                if one and two and one != two:
                    ok = v and w and ratio.partial(v, w) >= 85
                else:
                    ok = not (v and w) or ratio.token_set(v, w) >= 45
                if ok:
                    taken = c
        if taken is None:
            taken = {"rep": k, "day": r["start_at"].date(), "title": r["title"], "city": "", "venue": "", "listings": set()}
            by_day.setdefault(taken["day"], []).append(taken)
        taken["listings"].add((r["source_id"], r["start_at"]))
        taken["city"], taken["venue"] = taken["city"] or r["city"], taken["venue"] or r["venue"]
        out[k] = taken["rep"]
    return out


def placed(spark, rows, ords, **cuts):
    """The clusters of rows as sets of their numbers, by the operator and by the definition; the summaries and rounds."""
    df = listings(spark, *rows).withColumn("at", F.col("ord")).drop("ord").join(spark.createDataFrame(list(enumerate(ords)), "at long, ord long"), "at").repartition(3)
    ranked = resolve.with_rank(df, registry(spark, *REGS)).select("source_id", F.col("rank.trust").alias("trust")).distinct().collect()
    found, latest, rounds = resolve.placed_rows(df, registry(spark, *REGS), **cuts)
    got = {r.at: r for r in found.select("at", "ord", "row", "cluster").collect()}
    assert len(got) == len(rows)
    number = {r.row: at for at, r in got.items()}
    want = sequential(rows, {r.source_id: r.trust == 0 for r in ranked}, lambda k: (got[k].ord, got[k].row))
    return {at: number[r.cluster] for at, r in got.items()}, want, latest, rounds


@pytest.mark.parametrize(("n", "seed"), [(90, 3), (160, 4)])
def test_placement_is_the_sequential_one(spark, n, seed):
    got, want, _, rounds = placed(spark, rows_of(n, seed), range(n))
    assert got == want and rounds == 1


def test_segments_of_days_meet_right_with_repeated_ord(spark):
    """20,000 listings whose input order repeats, one component, cut into many segments that begin wrong and are put right."""
    rng, rows = random.Random(6), []
    for k in range(20_000):
        r = rows_of(1, rng.random())[0]
        r["start_at"] = datetime(2026, 1, 1) + timedelta(days=rng.randrange(400), hours=rng.choice((10, 19)))
        rows.append(r)
    got, want, latest, rounds = placed(spark, rows, [k // 3 % 5_000 for k in range(20_000)], segment=700, warm=1)
    assert got == want and rounds > 1
    sizes = {}
    for r in latest.collect():
        sizes.setdefault(r.component, []).append(r.segment)
    assert max(map(len, sizes.values())) > 20
    starts = [r["start_at"].date() for r in rows]
    assert max(abs((starts[a] - starts[b]).days) for a, b in got.items()) == 1


def test_events_keep_their_listings_where_ord_repeats(spark):
    rows = [dict(source_id=s, title="Harvest Fair", start_at=datetime(2026, 11, d, 10)) for s, d in (("a", 1), ("b", 1), ("a", 9))]
    df = listings(spark, *rows).withColumn("ord", F.lit(7).cast("long"))
    events = resolve.group_events(df, registry(spark, *REGS)).collect()
    assert sorted((e.start_at.day, sorted(e.source_ids)) for e in events) == [(1, ["a", "b"]), (9, ["a"])]
    assert [tuple(r) for r in resolve.candidate_pairs(df).collect()] == [(7, 7)]


def test_same_event_column(spark):
    rows = rows_of(40, 5)
    df = listings(spark, *rows).select("ord", F.struct("title", "start_at", "city", "venue").alias("x"))
    got = {(r.p, r.q): r.same for r in df.select(F.col("ord").alias("p"), F.col("x").alias("a")).join(df.select(F.col("ord").alias("q"), F.col("x").alias("b")), F.col("p") < F.col("q")).select("p", "q", resolve.same_event("a", "b").alias("same")).collect()}
    for (p, q), same in got.items():
        a, b = rows[p], rows[q]
        days = abs((a["start_at"].date() - b["start_at"].date()).days) <= 1
        one, two, v, w = plain(a["city"]), plain(b["city"]), plain(a["venue"]), plain(b["venue"])
        place = bool(v and w and ratio.partial(v, w) >= 85) if one and two and one != two else not (v and w) or ratio.token_set(v, w) >= 45
        assert same == (days and ratio.token_set(plain(a["title"]), plain(b["title"])) >= 78 and place)
