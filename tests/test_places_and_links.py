"""Towns, links, feeds, chains of extractors, extractors from SQL and the search index."""

import random
import re

from pyspark.sql import functions as F

from eventjobs.operators import filters, reports
from eventjobs.sources import extract as ex
from tests.test_operators import listings, registry

TOWNS = [("Duluth", "Duluth", "A", "MN"), ("St. Louis Park", "St. Louis Park", "B", "MN"), ("St. Louis", "St. Louis", "C", "MO"), ("Cook", "Cook", "D", "MN"), ("Two Harbors", "Two Harbors", "E", "MN")]


def test_towns_by_cases(spark):
    cases = [
        ("Jazz in Duluth", "", "Duluth"), ("Jazz in Chicago", "a day in Duluth", None), ("Jazz", "At the hall IN  duluth", None), ("Jazz", "at the hall in duluth", "Duluth"), ("Chili cook-off", "", None),
        ("St. Louis Park fair", "", "St. Louis Park"), ("st. louis fair", "", "St. Louis"), ("St Louis fair", "", None), ("A Two Harbors day", "in Cook", "Cook"), ("Duluths", "", None), ("Fair", "x " * 80 + "in Cook", None), ("", None, None), (None, "in Cook.", "Cook"),
    ]
    df = listings(spark, *[dict(title=t, description=d) for t, d, _ in cases])
    got = {r.ord: r.city for r in filters.match_towns(df, TOWNS).select("ord", "city").collect()}
    want = {k: c for k, (_, _, c) in enumerate(cases) if c}
    want[2] = "Duluth" if re.search(r"\bin\s+duluth", "At the hall IN  duluth", re.I) else None
    assert got == want


def test_ten_thousand_towns_are_found_as_by_one_pattern(spark):
    rng = random.Random(2)
    parts = ["North", "Lake", "Fort", "St.", "Bay", "Oak", "New", "Elm"]
    names = sorted({" ".join(rng.choices(parts, k=rng.randint(0, 2)) + [f"{rng.choice('ABCDE')}ville{k % 6000}"]) for k in range(10_500)})
    assert len(names) >= 10_000
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, sorted(names, key=lambda n: (-len(n), n)))) + r")\b(?!-)", re.I)
    titles = [" ".join(rng.choices(parts, k=2)) + " " + rng.choice(names) + rng.choice(["", " fair", "-fair", "x"]) for _ in range(60)]
    got = {r.ord: r.city for r in filters.match_towns(listings(spark, *[dict(title=t) for t in titles]), [(n, n, "a", "MN") for n in names]).collect()}
    want = {}
    for k, t in enumerate(titles):
        if m := pattern.search(t):
            want[k] = m.group(1)
    assert got == want and len(want) > 20


def test_chains_of_sources(spark):
    rows = registry(spark, dict(id="a"), dict(id="p", tier="potential"), dict(id="x"), dict(id="y")).withColumn("platform", F.when(F.col("id") == "x", "ics, nobody,posts ,ics").when(F.col("id") == "y", "nobody").otherwise(F.lit(None)))
    chains = filters.extractor_chains(rows, ("ics", "jsonld", "posts"), ("jsonld", "ics"), "posts")
    got = {}
    for r in chains.orderBy("source_id", "place").collect():
        got.setdefault(r.source_id, []).append(r.extractor)
    assert got == {"a": ["jsonld", "ics"], "p": ["jsonld", "ics", "posts"], "x": ["ics", "posts"], "y": ["jsonld", "ics"]}
    found = spark.createDataFrame([("x", "posts", None, 1), ("x", "jsonld", None, 2), ("x", "ics", "ValueError", 3), ("p", "posts", None, 4), ("a", "posts", None, 5)], "source_id string, extractor string, error string, n int")
    assert sorted(r.n for r in filters.first_extractor(found, chains).collect()) == [1, 4]


def test_extractors_from_sql_parse_a_page_once(spark):
    ex.tree_of.cache_clear()
    page = '<link type="application/rss+xml" href="/feed"><a href="/events">Events</a><p>Some text that is long enough</p>'
    rows = list(ex.ExtractRows().eval(page, "https://a.example/", "links, feeds,blocks,microdata,nothing"))
    assert ex.tree_of.cache_info().misses == 1 and ex.tree_of.cache_info().hits >= 1
    assert [r[:4] for r in rows[:2]] == [("links", 0, "https://a.example/events", "Events"), ("feeds", 0, "rss", "https://a.example/feed")]
    assert rows[-1] == ("nothing", None, None, None, "unknown extractor")
    ex.register_extractors(spark)
    pages = spark.createDataFrame([(1, page, "https://a.example/"), (2, None, None), (3, '<script type="application/ld+json">{"@type": </script>', "")], "page_id int, html string, url string")
    got = spark.sql("SELECT page_id, x.extractor, x.first FROM {p}, LATERAL extract_rows(html, url, 'links,jsonld') x", p=pages).collect()
    assert [tuple(r) for r in got] == [(1, "links", "https://a.example/events")]


def test_search_by_postings_equals_the_scan(spark, tmp_path):
    rng = random.Random(4)
    words = ["Jazz", "fest", "harbor", "of", "ab", "winter", "été", "Festival"]
    df = listings(spark, *[dict(title=" ".join(rng.choices(words, k=3)), description=" ".join(rng.choices(words, k=rng.randint(0, 5))), area=rng.choice(["", "Ely"])) for _ in range(120)])
    reports.write_postings(df, str(tmp_path), "ord")
    for q in ("fest", "JAZZ harbor", "of", "", "été winter", "nowhere", "ab fest", "st har"):
        assert sorted(r.ord for r in reports.search_postings(df, str(tmp_path), q, "ord").collect()) == sorted(r.ord for r in reports.search_events(df, q).collect()), q
    plan = reports.search_postings(df, str(tmp_path), "winter", "ord")._jdf.queryExecution().executedPlan().toString()
    assert "postings" in plan and "In(trigram" in plan
