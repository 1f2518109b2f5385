"""Entity resolution: listings of the same event from several sources become one merged event.

Listings are compared on days at most one apart and title similarity, both fixed from the beginning, so the titles that
pass are a superset of what a sequential pass could match. Listings are placed in order, as each placement depends on
those before it. Titles connected by similar ones are a component, and components are independent; a component's days
are cut into segments that are placed at the same time and put right where they meet (placed_rows). A task streams a
segment's rows and holds the clusters of two days only. ord, the input order, may repeat: rows have an id of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import effective_tier, fingerprint, norm, text_or_empty
from ..functions.ratio import partial, partial_ratio, token_set, token_set_ratio
from ..sources.io import written
from .alike import dealt, similar_days, spread_files, title_days, word_set

TITLE, VENUE_SAME, VENUE_OTHER = 78, 85, 45
FILLED = ("venue", "address", "city", "description", "image", "price", "url")
WEAK = ("other", "community")


def rank_struct(high: Column, *last: str) -> Column:
    """The order in which listings are placed: start, trusted first, read from text last, the richest first, input order."""
    rich = sum((text_or_empty(c) != "").cast("int") for c in ("description", "venue", "image", "price")) + F.col("end_at").isNotNull().cast("int")
    return F.struct("start_at", F.when(high, 0).otherwise(1).alias("trust"), F.coalesce(F.col("inferred").cast("int"), F.lit(0)).alias("inferred"), (-rich).alias("rich"), "ord", *last)


def with_rank(listings: DataFrame, registry: DataFrame) -> DataFrame:
    facts = registry.select(F.col("id").alias("source_id"), (effective_tier() == "trusted").alias("high"), F.col("name").alias("source_name"), F.when(text_or_empty("events_url") != "", F.col("events_url")).otherwise(text_or_empty("url")).alias("source_url"))
    return listings.join(facts, "source_id", "left").withColumn("rank", rank_struct(F.coalesce("high", F.lit(False)), *(c for c in ("row",) if c in listings.columns)))


def collapse_exact(listings: DataFrame, registry: DataFrame) -> DataFrame:
    """Listings with the same fingerprint as one merged event: fields of the first by rank, blanks filled from the next ones, provenance.

    Two aggregates (source within event, event), both with a map-side part, so a much copied event is no task's burden."""
    rows = with_rank(listings, registry).withColumn("fingerprint", fingerprint("title", "start_at", "city"))
    first = lambda c, ok: F.min_by(F.when(ok, F.col(c)), F.when(ok, F.col("rank")))
    fields = {c: F.coalesce(first(c, text_or_empty(c) != ""), F.lit("")) for c in FILLED}
    plain = {c: F.min_by(c, "rank") for c in ("ord", "title", "start_at", "all_day", "state", "area")}
    strong = ~F.col("category").isin(*WEAK)
    events = rows.groupBy("fingerprint").agg(
        *[v.alias(c) for c, v in {**plain, **fields}.items()],
        first("end_at", F.col("end_at").isNotNull()).alias("end_at"),
        F.min_by("category", "rank").alias("_category"), first("category", strong).alias("_strong"),
    )
    events = events.withColumn("category", F.when(F.col("_category").isin(*WEAK), F.coalesce("_strong", "_category")).otherwise(F.col("_category"))).drop("_category", "_strong")
    return events.join(provenance(rows, "fingerprint"), "fingerprint")


def provenance(rows: DataFrame, key: str) -> DataFrame:
    """key, source_ids, source_links and inferred_sources in the order in which sources came (rows have a rank)."""
    link = F.struct(F.coalesce("source_name", "source_id").alias("name"), F.when(text_or_empty("url") != "", F.col("url")).otherwise(text_or_empty("source_url")).alias("url"))
    per = rows.groupBy(key, "source_id").agg(F.min("rank").alias("rank"), F.min_by(link, "rank").alias("link"), F.bool_and(F.coalesce("inferred", F.lit(False))).alias("read"))
    listed = per.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "source_id", "link", "read"))).alias("s"))
    return listed.select(key, F.transform("s", lambda x: x["source_id"]).alias("source_ids"), F.transform("s", lambda x: x["link"]).alias("source_links"), F.transform(F.filter("s", lambda x: x["read"]), lambda x: x["source_id"]).alias("inferred_sources"))


def title_pairs(listings: DataFrame, least: float = TITLE) -> DataFrame:
    """day_a, title_a, day_b, title_b (ids of word sets, day_b the same day or the next) that are similar enough; a title is similar to itself on the next day and, once, on the same one."""
    near, _ = similar_days(listings, least)
    days = title_days(listings).select("day", "id")
    own = days.select(F.col("day").alias("day_a"), F.col("id").alias("title_a"), F.col("day").alias("day_b"), F.col("id").alias("title_b"))
    ahead = days.select(F.col("day").alias("day_a"), F.col("id").alias("title_a")).join(days.select(F.date_sub("day", 1).alias("day_a"), F.col("day").alias("day_b"), F.col("id").alias("title_a"), F.col("id").alias("title_b")), ["day_a", "title_a"]).select("day_a", "title_a", "day_b", "title_b")
    return near.toDF("day_a", "title_a", "day_b", "title_b").union(own).union(ahead)


def candidate_pairs(listings: DataFrame, least: float = TITLE) -> DataFrame:
    """ord_a, ord_b of listings that may be one event: similar titles, a day apart at most, not two dates of one source.

    Listings of one title, day, source and start are one node (the least ord), and a star to it links them. Where ord
    repeats, listings of one ord are still told apart: their pairs are those of the same ord twice."""
    listings = spread_files(written(listings.select("ord", "source_id", "start_at", word_set("title").alias("words")).withColumn("row", F.monotonically_increasing_id())))
    rows = listings.select(F.struct("ord", "row").alias("id"), "source_id", "start_at", F.to_date("start_at").alias("day"), "words").where("words <> ''").withColumn("title", F.xxhash64("words")).drop("words")
    nodes = written(rows.groupBy("day", "title", "source_id", "start_at").agg(F.min("id").alias("node")))
    joined = title_pairs(listings, least).join(nodes.select(*[F.col(c).alias(f"{c}_a") for c in nodes.columns]), ["day_a", "title_a"]).join(nodes.select(*[F.col(c).alias(f"{c}_b") for c in nodes.columns]), ["day_b", "title_b"])
    same = (F.col("day_a") == F.col("day_b")) & (F.col("title_a") == F.col("title_b"))
    real = joined.where(F.when(same, F.col("node_a") < F.col("node_b")).otherwise(F.col("node_a") != F.col("node_b")) & ((F.col("source_id_a") != F.col("source_id_b")) | (F.col("start_at_a") == F.col("start_at_b"))))
    real = real.select(F.least("node_a.ord", "node_b.ord").alias("ord_a"), F.greatest("node_a.ord", "node_b.ord").alias("ord_b"))
    stars = rows.join(nodes, ["day", "title", "source_id", "start_at"]).where("id <> node").select(F.col("node.ord").alias("ord_a"), F.col("id.ord").alias("ord_b"))
    return real.union(stars)


def components(pairs: DataFrame, a: str = "ord_a", b: str = "ord_b") -> DataFrame:
    """ord, component (the least ord reachable) of everything in pairs: least neighbours and jumps along labels until nothing changes."""
    edges = written(pairs.select(F.col(a).alias("ord"), F.col(b).alias("to")).union(pairs.select(F.col(b), F.col(a))).distinct())
    labels = written(edges.groupBy("ord").agg(F.least("ord", F.min("to")).alias("component")))
    while True:
        near = edges.join(labels.select(F.col("ord").alias("to"), "component"), "to").groupBy("ord").agg(F.min("component").alias("near"))
        step = labels.join(near, "ord").select("ord", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("ord").alias("component"), F.col("component").alias("further"))
        new = written(step.join(jump, "component", "left").select("ord", "old", F.least("component", F.coalesce("further", "component")).alias("component")))
        labels = new.select("ord", "component")
        if new.where("old <> component").isEmpty():
            return labels


def same_event(a: str, b: str, least: float = TITLE) -> Column:
    """E4: whether two listings, structs of title, start_at, city and venue, are one event."""
    title_a, title_b, city_a, city_b, venue_a, venue_b = (norm(F.col(f"{x}.{c}")) for c in ("title", "city", "venue") for x in (a, b))
    days = F.abs(F.datediff(F.to_date(F.col(f"{a}.start_at")), F.to_date(F.col(f"{b}.start_at"))))
    both_cities, both_venues = (city_a != "") & (city_b != ""), (venue_a != "") & (venue_b != "")
    place = F.when(both_cities & (city_a != city_b), both_venues & (partial_ratio(venue_a, venue_b) >= VENUE_SAME)).otherwise(~both_venues | (token_set_ratio(venue_a, venue_b) >= VENUE_OTHER))
    return F.coalesce((days <= 1) & (token_set_ratio(title_a, title_b) >= least) & place, F.lit(False))


class Clusters:
    """The clusters of one title component as its rows come, day by day: each knows what its representative is and has been given."""

    def __init__(self) -> None:
        self.day = None
        self.similar: dict[int, dict[int, frozenset[int]]] = {}  # day -> title -> similar titles of that day and the one before
        self.held: dict[int, dict[int, list[list]]] = {}  # day -> title of representatives -> their clusters
        self.made = 0
        self.venues = lru_cache(1 << 14)(lambda x, y, other: partial(x, y) >= VENUE_SAME if other else token_set(x, y) >= VENUE_OTHER)

    def on(self, day: int) -> None:
        if day != self.day:
            self.day = day
            for table in (self.similar, self.held):
                for old in [d for d in table if d < day - 1]:
                    del table[old]

    def fits(self, city: str, venue: str, own_city: str, own_venue: str) -> bool:
        both = bool(venue and own_venue)
        if city and own_city and city != own_city:
            return both and self.venues(venue, own_venue, True)
        return not both or self.venues(venue, own_venue, False)

    def hold(self, day: int, title: int, row: int, starts: dict[str, int], city: str, venue: str) -> None:
        self.made += 1
        self.held.setdefault(day, {}).setdefault(title, []).append([self.made, row, starts, city, venue])

    def place(self, row: int, day: int, title: int, source: str, start: int, city: str, venue: str) -> int:
        """The row of the cluster's representative that a listing goes to, its own if none takes it."""
        titles = self.similar.get(day, {}).get(title, frozenset()) | {title}
        for at in (day - 1, day):
            table = self.held.get(at)
            if not table:
                continue
            open_ = [c for t in (titles & table.keys()) for c in table[t]]
            for cluster in sorted(open_):
                _, rep, starts, own_city, own_venue = cluster
                if starts.get(source, start) == start and self.fits(own_city, own_venue, city, venue):
                    starts[source] = start
                    cluster[3], cluster[4] = own_city or city, own_venue or venue
                    return rep
        self.hold(day, title, row, {source: start}, city, venue)
        return row

    def of(self, day: int) -> list[tuple]:
        """The clusters of a day in the order in which they were made: title, row of the representative, starts by source, city, venue."""
        return [(t, row, sorted(starts.items()), city, venue) for _, t, row, starts, city, venue in sorted((c[0], t, *c[1:]) for t, some in self.held.get(day, {}).items() for c in some)]


def digest(clusters: list[tuple]) -> str:
    return hashlib.sha256(repr(clusters).encode()).hexdigest() if clusters else ""


#: What a placing task gives back: listings with their cluster, clusters of a segment's last day, and one summary of each segment.
LISTING, BOUNDARY, SUMMARY = 0, 1, 2
PLACED = "component long, segment long, kind int, row long, cluster long, day int, seq int, title long, starts array<struct<source:string,start:long>>, city string, venue string, first int, last int, begun string, ended string"
TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<struct<source:string,start:long>>": pa.list_(pa.struct([("source", pa.string()), ("start", pa.int64())]))}
#: Rows that a placing task reads, in this order within a day: clusters that stand at the segment's beginning, similar titles, listings.
STANDING, HEAD, BODY = 0, 1, 2
#: Listings of a segment, more if one day has more; segments of a table at most, beside one for each day; days before a segment that are placed along.
SEGMENT, SEGMENTS, WARM = 25_000, 4096, 45


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by component, segment, day, kind and rank: placements, the clusters of each segment's last day, its summary."""
    schema = pa.schema([(c, TYPES[t]) for c, t in (x.split(" ") for x in PLACED.split(", "))])
    empty = (None,) * 8
    name, state, first, begun, out = None, Clusters(), None, "", []

    def end() -> None:
        if name is None or first is None:
            return
        standing = state.of(state.day)
        for seq, (title, row, starts, city, venue) in enumerate(standing):
            out.append((*name, BOUNDARY, row, None, state.day, seq, title, [{"source": s, "start": t} for s, t in starts], city, venue, None, None, None, None))
        out.append((*name, SUMMARY, None, None, None, None, None, None, None, None, first, state.day, begun, digest(standing)))

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [[] for _ in schema]
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("component", "segment", "day", "kind", "warm", "row", "title", "source_id", "start", "city", "venue", "similar", "starts")]
        for component, segment, day, kind, warm, row, title, source, start, city, venue, similar, starts in zip(*columns, strict=True):
            if (component, segment) != name:
                end()
                name, state, first, begun = (component, segment), Clusters(), None, ""
            state.on(day)
            if kind == STANDING:
                state.hold(day, title, row, {x["source"]: x["start"] for x in starts}, city, venue)
            elif kind == HEAD:
                state.similar.setdefault(day, {})[title] = frozenset(similar)
            elif warm:
                state.place(row, day, title, source, start, city, venue)
            else:
                if first is None:
                    first, begun = day, digest(state.of(day - 1))
                out.append((*name, LISTING, row, state.place(row, day, title, source, start, city, venue), *empty, None, None))
        yield batch_of()
    end()
    yield batch_of()


def segments(named: DataFrame, rows: DataFrame, segment: int, warm: int) -> DataFrame:
    """date, title, component, segment, warm: each day of a component's titles is of one segment and, if warm, placed along before the next one.

    Days are counted off by listings, so a segment has about so many, or those of one day. The windows are over one row
    for each component and day, a calendar's worth of them. A segment's last days, up to its size again, are warm."""
    sizes = rows.groupBy("date", "title").agg(F.count("*").alias("n")).join(named, ["date", "title"])
    days = sizes.groupBy("component", "date").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("component").orderBy("date")
    days = days.withColumn("segment", F.floor((F.sum("n").over(order) - F.col("n")) / segment))
    own = Window.partitionBy("component", "segment").orderBy(F.desc("date"))
    days = days.withColumns({"left": F.sum("n").over(own) - F.col("n"), "last": F.max("date").over(Window.partitionBy("component", "segment"))})
    days = days.withColumn("next", F.lead("segment").over(order)).withColumn("next", F.last("next").over(Window.partitionBy("component", "segment").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    along = F.col("next").isNotNull() & (F.col("left") < segment) & (F.datediff("last", "date") < warm)
    reads = days.select("component", "date", F.explode(F.filter(F.array(F.struct(F.col("segment"), F.lit(False).alias("warm")), F.when(along, F.struct(F.col("next").alias("segment"), F.lit(True).alias("warm")))), lambda x: x.isNotNull())).alias("x"))
    return sizes.select("date", "title", "component").join(reads.select("component", "date", "x.*"), ["component", "date"])


def placed_rows(listings: DataFrame, registry: DataFrame, segment: int | None = None, warm: int = WARM) -> tuple[DataFrame, DataFrame, int]:
    """Listings with a row (an id of their own), rank and cluster (the row of its representative); the segments' summaries; rounds.

    Placement is sequential by definition, each listing after all before it. But what stands on one day matters to the
    next day only, and differences die out. So each component of titles is cut into segments of days that are placed at
    once, each after some warm days that are placed along. A segment is right if the clusters that stood at its
    beginning are those with which the one before it has ended. Segments for which that does not hold are placed once
    more, from that end, until it holds for all: then the result is the sequential one, whatever the cuts."""
    plain = [c for c in listings.columns if c not in ("row", "rank", "words", "cluster")]
    rows_of = spread_files(written(listings.select(*plain, F.monotonically_increasing_id().alias("row"))))
    keyed = written(with_rank(rows_of.withColumn("words", word_set("title")), registry))
    near, good = similar_days(keyed, TITLE)
    days = lambda c: F.unix_date(F.col(c)).alias("day")
    labels = components(good, "low", "high").select(F.col("ord").alias("title"), "component")
    named = title_days(keyed).select(F.col("day").alias("date"), F.col("id").alias("title")).join(labels, "title", "left").withColumn("component", F.coalesce("component", "title"))
    rows = keyed.select(
        "row", "source_id", "rank", F.to_date("start_at").alias("date"), F.xxhash64("words").alias("title"), F.unix_micros(F.col("start_at").cast("timestamp")).alias("start"),
        norm("city").alias("city"), norm("venue").alias("venue"),
    )
    size = segment or max(SEGMENT, -(-keyed.count() // SEGMENTS))
    reads = written(segments(named, rows, size, warm))
    # Of each title on a day: the similar titles of that day and of the one before.
    similar = near.select(F.col("day_b").alias("date"), F.col("id_b").alias("title"), F.col("id_a").alias("other")).union(near.where("day_a = day_b").select("day_a", F.col("id_a").alias("title"), F.col("id_b").alias("other")))
    heads = similar.groupBy("date", "title").agg(F.collect_set("other").alias("similar"))
    body = rows.join(reads, ["date", "title"])
    several = rows.join(reads.where("not warm"), ["date", "title"]).groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    nothing = lambda kind: F.lit(None).cast(kind)
    rank_type, starts_type = keyed.schema["rank"].dataType, "array<struct<source:string,start:bigint>>"
    stream = body.select("component", "segment", days("date"), F.lit(BODY).alias("kind"), "warm", "rank", "row", "title", "source_id", "start", "city", "venue", nothing("array<bigint>").alias("similar"), nothing(starts_type).alias("starts"), F.lit(0).alias("seq"))
    head = heads.join(reads, ["date", "title"]).select("component", "segment", days("date"), F.lit(HEAD), "warm", nothing(rank_type), nothing("long"), "title", nothing("string"), nothing("long"), nothing("string"), nothing("string"), "similar", nothing(starts_type), F.lit(0))
    stream = written(stream.union(head).join(several, "component", "left_semi"))

    def place(some: DataFrame) -> DataFrame:
        ordered = dealt(some, "component", "segment").sortWithinPartitions("component", "segment", "day", "kind", "seq", "rank")
        return written(ordered.drop("rank", "seq").mapInArrow(_placed, PLACED))

    done = [place(stream)]
    latest = written(done[0].where(F.col("kind") == SUMMARY).select("component", "segment", "first", "last", "begun", "ended", F.lit(0).alias("round")))
    order = Window.partitionBy("component").orderBy("segment")
    while True:
        meets = F.lag("last").over(order) == F.col("first") - 1
        before = latest.select("component", "segment", "begun", F.lag("segment").over(order).alias("before"), F.coalesce(F.when(meets, F.lag("ended").over(order)), F.lit("")).alias("due"), F.coalesce(F.when(meets, F.lag("round").over(order)), F.lit(-1)).alias("at"))
        wrong = written(before.where("begun <> due").select("component", "segment", "before", "due", "at"))
        if wrong.isEmpty():
            break
        turn = len(done)
        # Segments that hold more than one day's listings, or a day each: their number is bounded, like that of wrong ones.
        standing = reduce(DataFrame.union, [t.where(F.col("kind") == BOUNDARY).withColumn("at", F.lit(k)) for k, t in enumerate(done)])
        ends = standing.withColumnRenamed("segment", "before").join(wrong.where("due <> ''").select("component", "before", "at", F.col("segment").alias("to")), ["component", "before", "at"])
        ends = ends.select("component", F.col("to").alias("segment"), "day", F.lit(STANDING), F.lit(True), nothing(rank_type), "row", "title", nothing("string"), nothing("long"), "city", "venue", nothing("array<bigint>"), "starts", "seq")
        again = stream.where(~F.col("warm")).join(wrong.select("component", "segment"), ["component", "segment"], "left_semi")
        # Similar titles of the day before are not asked for: its clusters stand already.
        done.append(place(again.union(ends)))
        new = done[-1].where(F.col("kind") == SUMMARY).select("component", "segment", "first", "last", "begun", "ended", F.lit(turn).alias("round"))
        latest = written(latest.join(wrong.select("component", "segment"), ["component", "segment"], "left_anti").union(new))
    listed = reduce(DataFrame.union, [t.where(F.col("kind") == LISTING).select("component", "segment", "row", "cluster").withColumn("round", F.lit(k)) for k, t in enumerate(done)])
    right = listed if len(done) == 1 else listed.join(latest.select("component", "segment", "round"), ["component", "segment", "round"], "left_semi")
    found = keyed.drop("words").join(right.select("row", "cluster"), "row", "left").withColumn("cluster", F.coalesce("cluster", "row"))
    return found, latest, len(done)


def cluster_listings(listings: DataFrame, registry: DataFrame) -> DataFrame:
    """listings with row (an id of their own, so that ord may repeat) and cluster: the row of the cluster's representative.
    Listings that no other one is similar to are their own cluster and meet no helper."""
    return placed_rows(listings, registry)[0]


def group_events(listings: DataFrame, registry: DataFrame) -> DataFrame:
    """Merged events: the representative's fields, blanks filled from its cluster in order, provenance, and the fingerprint of the result."""
    rows = written(cluster_listings(listings, registry))
    first = lambda c, ok: F.min_by(F.when(ok, F.col(c)), F.when(ok, F.col("rank")))
    strong = ~F.col("category").isin(*WEAK)
    merged = rows.groupBy("cluster").agg(
        *[F.min_by(c, "rank").alias(c) for c in ("title", "start_at", "all_day", "state", "area")],
        *[F.coalesce(first(c, text_or_empty(c) != ""), F.lit("")).alias(c) for c in FILLED],
        first("end_at", F.col("end_at").isNotNull()).alias("end_at"), F.min_by("category", "rank").alias("_category"), first("category", strong).alias("_strong"),
    )
    merged = merged.withColumn("category", F.when(F.col("_category").isin(*WEAK), F.coalesce("_strong", "_category")).otherwise(F.col("_category"))).drop("_category", "_strong")
    return merged.join(provenance(rows, "cluster"), "cluster").withColumn("fingerprint", fingerprint("title", "start_at", "city"))
