"""Operators as DataFrames against cases."""

import random
from datetime import date, datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventjobs.functions import columns as c
from eventjobs.functions.text import clean_text
from eventjobs.operators import feedback, filters, recur, reports, resolve, series, trust
from eventjobs.plans import daily
from eventjobs.sources import extract as ex
from eventjobs.sources import feeds, io, stores
from eventjobs.streaming.jobs import history_stream, screen_reports_stream

AS_OF = datetime(2026, 10, 12)
REG = "id string, name string, url string, events_url string, category string, state string, area string, status string, trust string, refresh string, tier string, autopromote string"
LST = "source_id string, ord long, title string, venue string, city string, state string, area string, address string, url string, description string, price string, image string, category string, start_at timestamp_ntz, end_at timestamp_ntz, all_day boolean, inferred boolean"


def registry(spark, *rows):
    base = dict(name="", url="", events_url="", category="venue", state="MN", area="Duluth", status="active", trust="", refresh="", tier="", autopromote="")
    return spark.createDataFrame([tuple((base | r)[x.split()[0]] for x in REG.split(", ")) for r in rows], REG)


def listings(spark, *rows):
    base = dict(source_id="a", ord=0, title="Fair", venue="", city="", state="", area="", address="", url="", description="", price="", image="", category="other", start_at=datetime(2026, 11, 12, 19), end_at=None, all_day=False, inferred=False)
    return spark.createDataFrame([tuple((base | {"ord": k} | r)[x.split()[0]] for x in LST.split(", ")) for k, r in enumerate(rows)], LST)


REGS = [dict(id="a"), dict(id="b", category="social", url="https://b.example"), dict(id="c", trust="low", url="https://www.b.example"), dict(id="d", tier="potential", url="https://d.example"), dict(id="e", trust="low", url="https://e.example")]


def test_tiers(spark):
    got = {r.id: r.t for r in registry(spark, *REGS).select("id", c.effective_tier().alias("t")).collect()}
    assert got == {"a": "trusted", "b": "source", "c": "source", "d": "potential", "e": "source"}


def events(spark, *rows):
    return resolve.group_events(listings(spark, *rows), registry(spark, *REGS))


@pytest.mark.parametrize(("sources", "inferred", "want"), [
    ("a", False, ("confirmed", None)), ("a", True, ("needs-review", trust.FROM_TEXT)), ("be", False, ("confirmed", None)), ("b", False, ("needs-review", trust.SINGLE)),
    ("bc", False, ("needs-review", trust.SINGLE)), ("bd", False, ("needs-review", trust.SINGLE)), ("d", False, ("needs-review", trust.POTENTIAL)), ("ad", False, ("confirmed", None)),
])
def test_classify(spark, sources, inferred, want):
    merged = resolve.collapse_exact(listings(spark, *[dict(source_id=s, inferred=inferred) for s in sources]), registry(spark, *REGS))
    got = trust.classify(merged, registry(spark, *REGS), ("fingerprint",)).collect()
    assert [(r.verification, r.review_reason) for r in got] == [want]


def test_same_source_nights_stay_apart(spark):
    rows = [dict(start_at=datetime(2026, 11, d, 19)) for d in (12, 13, 14, 15)]
    assert events(spark, *rows).count() == 4
    assert events(spark, rows[0], rows[0]).count() == 1
    both = events(spark, dict(source_id="a"), dict(source_id="b", start_at=datetime(2026, 11, 13, 19), venue="Hall")).collect()
    assert [(sorted(r.source_ids), r.venue) for r in both] == [(["a", "b"], "Hall")]


def test_not_public_and_windows(spark):
    keep = ["Closed Captioned Movie", "Festival", "Library closed", "Staff Only", "Office is closed", "Horizon Training for Library Staff"]
    df = listings(spark, *[dict(title=x) for x in keep])
    assert [r.title for r in filters.drop_not_public(df).collect()] == ["Closed Captioned Movie", "Festival"]
    many = listings(spark, *[dict(title=" Yoga ", start_at=datetime(2026, 10, 1 + k % 28)) for k in range(20)], dict(title="yoga", start_at=datetime(2027, 2, 1)), dict(title="Once", start_at=datetime(2027, 2, 1)))
    assert sorted(r.title for r in filters.trim_frequent(many, AS_OF).where("start_at > '2027-01-01'").collect()) == ["Once"]
    assert filters.in_window(listings(spark, dict(start_at=datetime(2026, 10, 11)), dict(start_at=datetime(2026, 10, 10, 23)), dict(start_at=datetime(2027, 4, 30)), dict(start_at=None)), AS_OF).count() == 2


def test_cache(spark):
    fresh = listings(spark, dict(source_id="a"))
    cache = listings(spark, dict(source_id="a", title="Old"), dict(source_id="b", title="Kept"), dict(source_id="c", title="Late")).withColumn("snapshot_at", F.when(F.col("source_id") == "c", F.lit("2026-10-01")).otherwise("2026-10-08").cast("timestamp_ntz"))
    got = filters.carry_forward(fresh, cache, registry(spark, *REGS), AS_OF)
    assert sorted((r.source_id, r.title, r.carried) for r in got.collect()) == [("a", "Fair", False), ("b", "Kept", True)]
    once = filters.upsert_cache(cache, fresh, AS_OF)
    assert sorted(map(str, filters.upsert_cache(once, fresh, AS_OF).collect())) == sorted(map(str, once.collect()))
    assert sorted((r.source_id, r.title) for r in once.collect()) == [("a", "Fair"), ("b", "Kept"), ("c", "Late")]


def test_midnight_and_series(spark):
    m = datetime(2026, 10, 20)
    rows = [dict(start_at=m, end_at=m, description="at 7:00pm"), dict(start_at=m, end_at=m, description="doors 6 pm, show 7:30 pm"), dict(start_at=m, description="6 pm, 8 pm"), dict(start_at=m, end_at=datetime(2026, 10, 23)),
            dict(start_at=m, end_at=datetime(2026, 10, 20, 23, 59)), dict(start_at=datetime(2026, 10, 16), end_at=datetime(2026, 10, 18, 23, 59)), dict(start_at=m, end_at=datetime(2026, 10, 20, 2))]
    got = [(r.start_at, r.end_at, r.all_day) for r in recur.fix_midnight(listings(spark, *rows)).orderBy("ord").collect()]
    assert got == [(datetime(2026, 10, 20, 19), None, False), (datetime(2026, 10, 20, 19, 30), None, False), (m, None, True), (m, datetime(2026, 10, 22, 23, 59, 59), True), (m, None, True), (datetime(2026, 10, 16), datetime(2026, 10, 18, 23, 59), True), (m, datetime(2026, 10, 20, 2), False)]
    spans = listings(spark, dict(end_at=datetime(2026, 11, 20), description="weekly class"), dict(end_at=datetime(2026, 12, 20)), dict(end_at=datetime(2026, 11, 1)))
    assert [r.end_at for r in recur.fix_series_span(spans).orderBy("ord").collect()] == [None, datetime(2026, 12, 20), None]


@pytest.mark.parametrize(("says", "first", "last", "want"), [
    ("Recurring weekly on Wednesday", date(2026, 10, 7), date(2026, 10, 21), ["2026-10-14", "2026-10-21"]),
    ("monthly on the 3rd Wednesday", date(2026, 9, 16), date(2026, 11, 30), ["2026-10-21", "2026-11-18"]),
    ("every 4 weeks on Thursday", date(2026, 3, 5), date(2026, 12, 11), ["2026-10-15", "2026-11-12", "2026-12-10"]),
    ("weekly on Tuesday, Saturday", date(2026, 10, 1), date(2026, 10, 17), ["2026-10-13", "2026-10-17"]), ("some other wording", date(2026, 10, 1), None, [None]), ("daily", date(2026, 10, 1), date(2026, 10, 13), ["2026-10-12", "2026-10-13"]),
])
def test_recurrence_text(spark, says, first, last, want):
    df = spark.createDataFrame([(says, first, last)], "recurrence string, first date, last date")
    assert [None if r.day is None else str(r.day) for r in recur.expand_recurrence_text(df, AS_OF.date()).orderBy("day").collect()] == want


COR = "key string, ord long, decision string, event string, field string, value string, was string, title string, date string, source string, kind string, decided_at string"


def fixes(spark, *rows):
    base = dict(key="k", decision="apply", event="e1", field="category", value="music", was="other", title="", date="", source="", kind="", decided_at="2026-10-01")
    return spark.createDataFrame([tuple((base | {"ord": k} | r)[x.split()[0]] for x in COR.split(", ")) for k, r in enumerate(rows)], COR)


def test_corrections(spark):
    ev = listings(spark, dict(), dict(), dict()).withColumn("fingerprint", F.concat(F.lit("e"), F.col("ord")))
    df = fixes(spark, dict(event="e0", field="when", value="2026-10-14T10:00/2026-10-14T11:00"), dict(event="e0", field="venue", value="Hall", decision="ignore"), dict(event="e1", field="hide", value=""), dict(event="e2", field="when", value="2026-10-14"))
    got = {r.fingerprint: (r.start_at, r.end_at, r.all_day, r.venue, r.corrected) for r in feedback.apply_corrections(ev, df).collect()}
    assert got == {"e0": (datetime(2026, 10, 14, 10), datetime(2026, 10, 14, 11), False, "", True), "e2": (datetime(2026, 10, 14), None, True, "", True)}


def test_learning(spark):
    none = spark.createDataFrame([], "key string, decision string")
    two = [dict(event="x1", title="Choir Gala"), dict(event="x2", title="Choir"), dict(event="x2", title="Choir", decided_at="2026-10-02")]
    v = feedback.verdicts(fixes(spark, *two))
    assert feedback.learn_rules(v, none).count() == 0 and {r.feature: r.support for r in feedback.rule_counts(v).collect()}["choir"] == 2
    v = feedback.verdicts(fixes(spark, *two, dict(event="x3", title="Choir")))
    rules = feedback.learn_rules(v, none)
    assert [(r.feature, r.support, r.enabled) for r in rules.collect()] == [("choir", 3, True)]
    off = feedback.learn_rules(v, spark.createDataFrame([("choir:other>music", "off")], "key string, decision string"))
    assert [r.enabled for r in off.collect()] == [False]
    ev = listings(spark, dict(title="Choir night"), dict(title="Choir night", category="arts")).withColumn("fingerprint", F.col("ord").cast("string"))
    assert [r.category for r in feedback.apply_learned(ev, rules).orderBy("ord").collect()] == ["music", "arts"]
    v = feedback.verdicts(fixes(spark, *two, dict(event="x3", title="Choir"), dict(event="x4", title="Choir", decision="reject"), dict(event="x5", title="Choir", decision="reject")))
    assert feedback.learn_rules(v, none).count() == 0


def test_series(spark):
    rows = [dict(title="45th Annual Blueberry Fest", area="Ely", start_at=datetime(y, 7, 4 + y % 3)) for y in (2024, 2025)] + [dict(title="Story Time", area="Ely", start_at=datetime(2026, k, 1)) for k in (1, 2, 3)]
    df = listings(spark, *rows).withColumn("source_count", F.lit(1))
    known = series.series_rows(df).join(series.edition_clusters(df.where("start_at > '2026-01-01'")).select("key", "too_frequent"), "key", "left")
    owner = spark.createDataFrame([], "key string, decision string")
    view = series.recurring_view(known, series.occurrences(df), owner).collect()
    assert [(r.key, r.status, r.years) for r in view] == [("blueberry fest|ely", "confirmed", 2)]
    leap = spark.createDataFrame([("k", 2024, "2024-02-29", "t", 1, "")], "key string, year int, date string, title string, source_count int, url string")
    assert series.predict_next(leap).first().predicted == "2025-02-28"
    old = known.limit(0), series.occurrences(df).limit(0)
    once = series.update_history(*old, df)
    again = series.update_history(*once, df)
    assert all(sorted(map(str, x.collect())) == sorted(map(str, y.collect())) for x, y in zip(once, again, strict=True))


def test_reports(spark):
    runs = "source_id string, date string, events long, queued long, carried boolean"
    hist = spark.createDataFrame([("d", f"2026-10-{k:02}", k % 4, 0, k == 9) for k in range(1, 12)], runs)
    one = reports.update_source_history(hist, spark.createDataFrame([("d", 5, False)], "source_id string, events long, carried boolean"), spark.createDataFrame([("d", 2)], "source_id string, queued long"), "2026-10-11")
    assert one.where("date = '2026-10-11'").collect()[0].events == 5 and one.count() == 11
    got = reports.promote_sources(registry(spark, dict(id="d", tier="potential", autopromote="yes")), hist).first()
    assert (got.promoted, got.tier) == (True, "source")
    snap = spark.createDataFrame([("2026-10-11", 1), ("2026-10-10", 2)], "date string, raw int")
    assert reports.append_stats(snap, spark.createDataFrame([("2026-10-11", 9)], "date string, raw int"), 1).collect()[0].raw == 9
    hits = reports.quality_hits(listings(spark, dict(title=" ", description="a%20b%20c%20", start_at=AS_OF), dict(description="x &amp; y", start_at=datetime(2026, 10, 12, 2)))).select("ord", "check").collect()
    assert sorted((r.ord, r.check) for r in hits) == [(0, "encoded"), (0, "midnight"), (0, "no-title"), (1, "html"), (1, "small-hours")]


def test_io(spark, tmp_path):
    path = str(tmp_path / "d.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('key,decision,title\na,approve,"x\ny"\na,REJECT,\nb,maybe,\n,approve,\n')
    assert [(r.key, r.decision) for r in io.read_decisions(spark, path, ("approve", "reject")).collect()] == [("a", "reject")]
    runs = str(tmp_path / "s")
    stores.publish_snapshot(listings(spark, dict(area="Ely"), dict(start_at=datetime(2026, 12, 1))), runs, AS_OF)
    with pytest.raises(RuntimeError, match="stopped after events"):  # a run that dies between its two tables
        stores.publish_snapshot(listings(spark, dict(area="Duluth")), runs, AS_OF, fails="events")
    head, held = stores.read_snapshot(spark, runs)
    assert [(h["count"], h["areas"], h["categories"]) for h in head.collect()] == [(2, ["Ely"], ["other"])] and held.count() == 2
    stores.publish_snapshot(listings(spark, dict(area="Duluth")), runs, AS_OF)
    head, held = stores.read_snapshot(spark, runs)
    assert (head.first()["count"], [r.area for r in held.collect()]) == (1, ["Duluth"])
    stores.publish_snapshot(listings(spark, dict()).limit(0), runs, AS_OF)
    assert [t.count() for t in stores.read_snapshot(spark, runs)] == [1, 0]
    reg = io.registry_defaults(spark.createDataFrame([(" x ", "https://a.example//")], "id string, url string")).first()
    assert (reg.id, reg.name, reg.url, reg.status) == ("x", "x", "https://a.example", "todo")


def test_extraction_jobs(spark):
    pages = spark.createDataFrame([(1, "https://a.example/", '<script type="application/ld+json">{"@graph":[{"@type":"Festival","name":"F &amp; G","startDate":"2026-12-09T13:45:00Z","offers":{"price":5}}]}</script>'), (2, "", "ld+json <script type='application/ld+json'>{</script>"), (3, None, None)], "page_id long, url string, html string")
    row = ex.extract_jsonld(pages).withColumn("start_at", ex.parse_wall_time("start_text", AS_OF)).collect()
    assert [(r.title, r.price, r.start_at, r.error) for r in row] == [("F & G", "$5", datetime(2026, 12, 9, 7, 45), None)]
    times = spark.createDataFrame([("2026-10-12T10:00:00-05:00",), ("2026-10-12 10:00",), ("Oct 12, 2026 7pm",), ("nonsense",), (None,)], "t string")
    assert [r.x for r in times.select(ex.parse_wall_time("t", AS_OF).alias("x")).collect()] == [datetime(2026, 10, 12, 10), datetime(2026, 10, 12, 10), datetime(2026, 10, 12, 19), None, None]
    assert spark.range(1).select(c.from_epoch(F.lit(1791849600)).alias("x")).first().x == datetime(2026, 10, 12, 19)
    body = "BEGIN:VEVENT\nUID:1\nSUMMARY:A\nDTSTART;VALUE=DATE:20261020\nRRULE:FREQ=DAILY\nEND:VEVENT\nBEGIN:VEVENT\nUID:1\nRECURRENCE-ID:20261021\nSUMMARY:B\nDTSTART:20261021T090000\nEND:VEVENT"
    parts = ex.extract_ics(spark.createDataFrame([("s", "", body)], "source_id string, url string, body string")).cache()
    assert [(r.title, r.all_day) for r in parts.orderBy("n").collect()] == [("A", True), ("B", False)]
    slots = spark.createDataFrame([("s", "1", datetime(2026, 10, d)) for d in (20, 21)], "source_id string, uid string, start_at timestamp_ntz")
    assert [r.start_at.day for r in ex.without_overridden(slots, parts).collect()] == [20]
    assert clean_text(F.lit("x")) is not None
    line = spark.range(1).select(feeds.parse_city_line(F.lit("Duluth, MN 55802")).alias("p"), feeds.state_of(F.lit("54806")).alias("s")).first()
    assert (line.p.city, line.p.state, line.p.zip, line.s) == ("Duluth", "MN", "55802", "WI")


def test_streams(spark, tmp_path):
    schema = "id string, at timestamp, visitor string, event string, kind string, website string, elapsed_ms long"
    rows = [(f"{k:02}", datetime(2026, 10, 12, 9, k), "u", "e1", "title", "", 5000) for k in range(12)] + [("x", datetime(2026, 10, 12, 9), "u2", "e9", "title", "", 5000), ("y", datetime(2026, 10, 12, 9), "u2", "e1", "title", "bot", 5000)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    published = spark.createDataFrame([("e1",)], "fingerprint string")
    q = screen_reports_stream(stream, published).writeStream.format("memory").queryName("screened").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.id for r in spark.table("screened").collect()) == [f"{k:02}" for k in range(8)]
    ledger = stores.Ledger(spark, str(tmp_path / "ledger"))
    ledger.commit("old", {"cache": (listings(spark, dict(source_id="a"), dict(source_id="b", start_at=datetime(2026, 10, 1))).withColumn("snapshot_at", F.lit("2026-10-10").cast("timestamp_ntz")), "source_id"), "stats": (spark.createDataFrame([("2026-10-01", 5)], "date string, raw long"), "date")})
    run = lambda checkpoint, fails=None: history_stream(drops, ledger, ("cache", "series", "stats"), registry(spark, *REGS), AS_OF, str(tmp_path / checkpoint), fails).start().awaitTermination()
    state = lambda: (sorted(r.source_id for r in ledger.read("cache").collect()), sorted(r.key for r in ledger.read("series").collect()), ledger.read("occurrences").count(), sorted((r.date, r.raw) for r in ledger.read("stats").collect()))
    listings(spark, dict(source_id="b"), dict(source_id="b", title="Bingo")).coalesce(1).write.parquet(str(tmp_path / "drop"))
    drops = spark.readStream.schema(LST).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "drop"))
    run("c2")
    first = state()
    assert first == (["a", "b", "b"], ["bingo|", "fair|"], 2, [("2026-10-01", 5), ("2026-10-12", 3)])
    files = {r.part: r.file for r in ledger.files("cache").collect()}
    listings(spark, dict(source_id="c", title="Zoo Day")).coalesce(1).write.mode("append").parquet(str(tmp_path / "drop"))
    for fails in ("cache", "occurrences", "stats"):  # dies after each of its tables: nothing of the batch is seen
        with pytest.raises(StreamingQueryException):
            run("c2", fails)
        assert state() == first
    run("c2")
    second = state()
    assert second[0] == ["a", "b", "b", "c"] and second[1] == ["bingo|", "fair|", "zoo day|"] and second[2] == 3
    run("c2")  # nothing new
    assert state() == second
    now = {r.part: r.file for r in ledger.files("cache").collect()}
    assert {p: now[p] for p in files} == files and set(now) == {"a", "b", "c"}
    run("c3")  # both drops once more, by a stream of its own
    assert state()[:3] == second[:3]


def exchanged(plan):
    """Of each scan of a bucketed table in a plan's tree whether an exchange stands above it."""
    out, above = [], []
    for line in plan.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*|"))
        above = [(d, x) for d, x in above if d < depth]
        if "FileScan" in line and "Bucketed: true" in line:
            out.append(any(x for _, x in above))
        above.append((depth, "Exchange" in line))
    return out


def test_history_in_buckets_is_not_shuffled(spark):
    old = spark.createDataFrame([("fair|", "Fair", "", "", "", "other", False), ("zoo|", "Zoo", "", "", "", "other", True)], "key string, title string, venue string, city string, area string, category string, too_frequent boolean")
    seen = spark.createDataFrame([("fair|", 2025, "2025-11-12", "Fair", 1, ""), ("fair|", 2026, "2026-01-01", "Fair", 1, ""), ("zoo|", 2024, "2024-01-01", "Zoo", 1, "")], "key string, year int, date string, title string, source_count int, url string")
    run = listings(spark, dict(), dict(title="Bingo")).withColumn("source_count", F.lit(1))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # a large history
    try:
        known, seen_now = series.update_history(stores.write_bucketed(old, "series_in_buckets", 8), stores.write_bucketed(seen, "occurrences_in_buckets", 8), run)
        for table in (known, seen_now):
            plan = table._jdf.queryExecution().executedPlan().toString()
            assert exchanged(plan) == [False] and "SortMergeJoin" in plan
        assert sorted((r.key, r.too_frequent) for r in known.collect()) == [("bingo|", False), ("fair|", False), ("zoo|", True)]
        assert sorted((r.key, r.date) for r in seen_now.collect()) == [("bingo|", "2026-11-12"), ("fair|", "2025-11-12"), ("fair|", "2026-11-12"), ("zoo|", "2024-01-01")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE IF EXISTS series_in_buckets")
        spark.sql("DROP TABLE IF EXISTS occurrences_in_buckets")


def test_gates_keep_rows_from_helpers(spark):
    """Rows outside the gate reach a helper as nulls, though Spark takes it out of the CASE."""
    from eventjobs.functions import text as texts

    def only_marked(s):
        assert all("&" in x for x in s if x is not None)
        return s.map(lambda x: None if x is None else x.upper())

    df = spark.createDataFrame([("a&b",), ("plain",), (None,)], "t string")
    gated = df.select(texts.gated(F.col("t").contains("&"), F.pandas_udf(only_marked, "string"), F.col("t")).alias("x"))
    assert [r.x for r in gated.collect()] == ["A&B", None, None]
    plan = spark.createDataFrame([("plain text",)], "t string").select(texts.clean_text("t").alias("x"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "CASE WHEN RLIKE" in plan.split("ArrowEvalPython", 1)[1]


def test_category_rules(spark):
    cases = {"Spring Chorale": "music", "Watercolor with Ann": "arts", "Snowshoe outing": "sports-rec", "Run/Walk for Hope": "sports-rec", "hip-hop hour": "music", "Concerted effort": "other", "Kid's hour": "family", "feat. Ann": "other", "Old St. Patrick": "holiday", "Class of five": "education", "pre-class": "education", "x_class": "other", "": "other"}
    df = spark.createDataFrame(list(cases.items()), "t string, want string").select("t", "want", c.infer_category("t", F.lit(""), F.lit("other")).alias("got"), c.infer_category(F.lit("Zzz"), "t", F.lit("other")).alias("said"))
    assert all(r.got == r.want == r.said for r in df.collect()), df.collect()


def test_daily_run(spark, tmp_path):
    rows = listings(spark, dict(source_id="a", title="Blueberry Festival"), dict(source_id="b", title="Quiet Talk"), dict(source_id="d", title="Library closed"))
    none = lambda s: spark.createDataFrame([], s)
    inputs = daily.Inputs(rows, registry(spark, *REGS), rows.where("false").withColumn("snapshot_at", filters.wall(AS_OF)), none("key string, decision string"), none(COR), none("key string, decision string"),
                          none("key string, title string, venue string, city string, area string, category string, too_frequent boolean"), none("key string, year int, date string, title string, source_count int, url string"))
    for exact in (True, False):
        out = daily.daily_run(inputs, AS_OF, exact=exact)
        assert [(r.title, r.tabling) for r in out.published.collect()] == [("Blueberry Festival", True)]
        assert [r.title for r in out.queue.collect()] == ["Quiet Talk"] and out.cache.count() == 2 and out.occurrences.count() == 1
    assert daily.daily_run(inputs, AS_OF, only=["a"], exact=True).published.count() == 0
    inputs.runs = none("source_id string, date string, events long, queued long, carried boolean")
    inputs.stats = none("date string, raw long, merged long, published long, queued long, active_sources long, categories map<string,long>")
    out = daily.daily_run(inputs, AS_OF, exact=True)
    daily.store(out, str(tmp_path / "day"), AS_OF)
    read = lambda name: spark.read.parquet(str(tmp_path / "day" / name))
    assert {r.source_id: (r.events, r.queued) for r in read("runs").collect()}["b"] == (1, 1) and read("history").count() == 1
    assert [r.decision for r in read("decisions").collect()] == [""] and read("counters").first().hidden == 0
    assert [t.count() for t in stores.read_snapshot(spark, str(tmp_path / "day/snapshot"))] == [1, 1]


def test_two_hours_of_one_day_are_two_events(spark):
    """They share title, day and city, so a fingerprint; the second hour has one witness only."""
    rows = listings(spark, *[dict(source_id=s, title="Harvest Fair", city="Ely", start_at=datetime(2026, 11, 12, h)) for s, h in (("b", 10), ("e", 10), ("b", 19))])
    none = lambda s: spark.createDataFrame([], s)
    inputs = daily.Inputs(rows, registry(spark, *REGS), rows.where("false").withColumn("snapshot_at", filters.wall(AS_OF)), none("key string, decision string"), none(COR), none("key string, decision string"),
                          none("key string, title string, venue string, city string, area string, category string, too_frequent boolean"), none("key string, year int, date string, title string, source_count int, url string"))
    out = daily.daily_run(inputs, AS_OF)
    assert [(r.start_at.hour, r.verification, r.source_ids) for r in out.published.collect()] == [(10, "confirmed", ["b", "e"])]
    assert [(r.start_at.hour, r.source_ids) for r in out.queue.collect()] == [(19, ["b"])]


def test_blocks_and_series(spark):
    block = "DTSTART:20260901T090000\nRRULE:FREQ=WEEKLY;BYDAY=TU;INTERVAL=0\nRDATE:20261022T090000\nEXDATE:20261020T090000"
    got = recur.occurrences_of_block(block, datetime(2026, 9, 1, 9), datetime(2026, 10, 12), datetime(2026, 10, 31))
    assert got == [datetime(2026, 10, 13, 9), datetime(2026, 10, 22, 9), datetime(2026, 10, 27, 9)]
    assert recur.occurrences_of_block(block, datetime(2010, 9, 1, 9), datetime(2026, 10, 12), datetime(2026, 10, 31)) == []
    day = lambda m, d: date(2026, m, d)
    rows = [
        (1, "weekly on wednesday", day(10, 7), day(10, 21), None, 600, 660), (2, "", day(10, 12), day(10, 30), [day(10, 14)], None, None), (3, "daily", day(10, 1), day(10, 30), None, None, None),
        (4, "", day(10, 17), None, None, 600, None), (5, "", day(10, 10), day(10, 13), None, None, None), (6, "when the moon is full", day(10, 1), None, [day(10, 2), day(10, 26)], 60, 30), (7, "daily", day(10, 11), day(10, 13), None, 1140, 1260),
    ]
    df = spark.createDataFrame(rows, "id int, recurrence string, first date, last date, listed array<date>, minutes int, end_minutes int")
    got = sorted((r.id, r.start_at, r.end_at, r.all_day) for r in recur.series_listings(df, day(10, 12)).collect())
    at = lambda d, h=0, m=0, s=0: datetime(2026, 10, d, h, m, s)
    assert [(r[0], r[1], r[2]) for r in got] == [
        (1, at(14, 10), at(14, 11)), (1, at(21, 10), at(21, 11)), (2, at(14), None), (3, at(1), at(30, 23, 59, 59)), (4, at(17, 10), None), (5, at(10), at(13, 23, 59, 59)), (6, at(26, 1), None), (7, at(12, 19), at(12, 21)), (7, at(13, 19), at(13, 21))]


def test_feed_presets(spark):
    bodies = [("weblink", '{"Events":[{"EventName":"A","StartDate":"2026-10-20T00:00:00","StartTime":"7:00 PM","Venue":"Hall","City":"Ely"}]}'), ("mycalendar", '{"events":[{"event_title":"B","occur_begin":"2026-10-20 19:00:00","event_label":"Hall","event_city":"Ely"}]}'),
              ("evvnt", '{"rawEvents":[{"title":"C","start_time":"2026-10-20T19:00:00","venue":{"name":"Hall","town":"Ely"}}]}'), ("agile", '{"ArrayOfEvent":[{"Name":"D","StartDate":"2026-10-20T19:00:00","Venue":{"Name":"Hall","City":"Ely"}},{"Name":"X","DateTBD":true,"StartDate":"2026-10-20T19:00:00"}]}')]
    for name, body in bodies:
        rows = feeds.map_json_feed(spark.createDataFrame([("s", body)], "source_id string, body string"), feeds.PRESETS[name], AS_OF).collect()
        assert [(r.venue, r.city, r.start_at) for r in rows] == [("Hall", "Ely", datetime(2026, 10, 20, 19))], name


def test_entry_without_optional_part(spark):
    import subprocess
    import sys

    code = "import sys; sys.modules['eventjobs.llm'] = None\nimport __spark_entry__ as e\nassert 'd1_in_window' in e.queries() and not any(n.startswith('op') for n in e.queries()), sorted(e.queries())"
    from tests.conftest import ROOT

    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True).stderr == ""
