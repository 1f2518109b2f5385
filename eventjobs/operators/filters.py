"""Filters and retention: which listings stay, which snapshots are carried forward."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cancelled, effective_tier, not_public, text_or_empty

HORIZON_DAYS, FREQUENT_COUNT, FREQUENT_DAYS = 200, 20, 60
CACHE_DAYS, LOCAL_CACHE_DAYS = 6, 10


def wall(as_of: datetime) -> Column:
    """as_of as a wall-clock literal; no job reads the clock."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def shifted(moment: Column, days: int) -> Column:
    return moment + F.expr(f"interval '{days}' day")


def in_window(df: DataFrame, as_of: datetime, horizon: int = HORIZON_DAYS) -> DataFrame:
    """Listings from a day before as_of to the horizon: a plain range, so it reaches the scan."""
    return df.where(F.col("start_at").between(shifted(wall(as_of), -1), shifted(wall(as_of), horizon)))


def trim_frequent(df: DataFrame, as_of: datetime, count: int = FREQUENT_COUNT, days: int = FREQUENT_DAYS) -> DataFrame:
    """A source's title that occurs count times or more shows only its next days.

    The counts are aggregated before the shuffle and joined back, so a source with most of the rows does not meet in
    one task; the join is Spark's to split where a title is skewed."""
    title = F.lower(F.trim(text_or_empty("title")))
    frequent = df.groupBy(F.col("source_id").alias("f_source"), title.alias("f_title")).agg(F.count("*").alias("n")).where(F.col("n") >= count).select("f_source", "f_title")
    late = F.col("start_at") > shifted(wall(as_of), days)
    hit = (F.col("source_id").eqNullSafe(F.col("f_source"))) & (title == F.col("f_title"))
    # Only late rows can go, so only they meet the frequent titles.
    return df.where(~F.coalesce(late, F.lit(False))).unionByName(df.where(late).join(frequent, hit, "left_anti"))


def drop_not_public(df: DataFrame) -> DataFrame:
    return df.where(~not_public("title"))


def drop_cancelled(df: DataFrame) -> DataFrame:
    return df.where(~cancelled("title"))


def snapshot_age(as_of: datetime) -> Column:
    return F.datediff(wall(as_of).cast("date"), F.col("snapshot_at").cast("date"))


def carry_forward(fresh: DataFrame, cache: DataFrame, registry: DataFrame, as_of: datetime, repair: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """fresh (carried = false) and, for sources without fresh rows, their cached snapshot if it is young enough.

    The carried rows are repaired as new ones are, if wanted (recur.normalize), as a snapshot may be older than a repair;
    then they pass the window and the public filter again, not the frequency trim."""
    limits = registry.select(F.col("id").alias("source_id"), F.when(F.lower(text_or_empty("refresh")).isin("local", "relay"), LOCAL_CACHE_DAYS).otherwise(CACHE_DAYS).alias("limit"))
    kept = cache.join(fresh.select("source_id").distinct(), "source_id", "left_anti").join(limits, "source_id").where(snapshot_age(as_of) <= F.col("limit"))
    kept = kept.drop("limit", "snapshot_at")
    kept = drop_not_public(in_window(repair(kept) if repair else kept, as_of))
    return fresh.withColumn("carried", F.lit(False)).unionByName(kept.withColumn("carried", F.lit(True)))


def upsert_cache(cache: DataFrame, fresh: DataFrame, as_of: datetime) -> DataFrame:
    """The cache with the snapshots of fresh sources replaced, others kept. Running it twice changes nothing."""
    kept = cache.join(fresh.select("source_id").distinct(), "source_id", "left_anti")
    return kept.unionByName(fresh.withColumn("snapshot_at", wall(as_of)))


def cap_series(df: DataFrame, n: int = 60) -> DataFrame:
    """The first n rows by start of each source and title: the cap is the feature."""
    rank = F.row_number().over(Window.partitionBy("source_id", "title").orderBy("start_at", "ord"))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def tag_from_source(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Blank state, area and city filled from the source; an area stands for the city unless it is a county."""
    known = registry.select(F.col("id").alias("source_id"), F.col("state").alias("r_state"), F.col("area").alias("r_area"))
    blank = lambda c, d: F.coalesce(F.when(F.col(c) != "", F.col(c)), d, F.lit(""))
    out = df.join(known, "source_id", "left").withColumns({"state": blank("state", F.col("r_state")), "area": blank("area", F.col("r_area"))})
    return out.withColumn("city", blank("city", F.when(~F.col("area").contains("County"), F.col("area")))).drop("r_state", "r_area")


def with_tier(registry: DataFrame) -> DataFrame:
    return registry.withColumn("effective_tier", effective_tier())


def extractor_chains(registry: DataFrame, known: Sequence[str], generic: Sequence[str], last: str) -> DataFrame:
    """source_id, extractor, place: the extractors of each source in the order in which they are tried (B19), as data.

    A source's platform pins them, several with commas, unknown names left out; without any it has the generic ones, and
    a potential source also the last one, which reads its text."""
    pinned = F.filter(F.transform(F.split(text_or_empty("platform"), ","), lambda x: F.trim(x)), lambda x: x.isin(*known))
    names = F.array(*map(F.lit, generic))
    rest = F.when(effective_tier() == "potential", F.array_append(names, F.lit(last))).otherwise(names)
    rows = registry.select(F.col("id").alias("source_id"), F.posexplode(F.when(F.size(pinned) > 0, pinned).otherwise(rest)).alias("place", "extractor"))
    return rows.groupBy("source_id", "extractor").agg(F.min("place").alias("place"))


def first_extractor(extracted: DataFrame, chains: DataFrame) -> DataFrame:
    """For each source the rows of the first extractor of its chain that made any; rows with an error and extractors outside the chain do not count."""
    good = extracted.where(F.col("error").isNull()) if "error" in extracted.columns else extracted
    placed = good.join(chains, ["source_id", "extractor"])
    first = placed.groupBy("source_id").agg(F.min("place").alias("_first"))
    return placed.join(first, "source_id").where(F.col("place") == F.col("_first")).drop("place", "_first")


def choose_extractor(extracted: DataFrame, order: Sequence[str]) -> DataFrame:
    """For each source the rows of the first extractor in one order for all (extractors outside it come last) that made any."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("extractor"))
    ranked = extracted.withColumn("_place", F.when(place > 0, place).otherwise(len(order) + 1))
    first = ranked.groupBy("source_id").agg(F.min("_place").alias("_first"))
    return ranked.join(first, "source_id").where(F.col("_place") == F.col("_first")).drop("_place", "_first")


def triage(extracted: DataFrame, registry: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of each source by extractor, and the first extractor that yields (B20)."""
    counts = extracted.groupBy("source_id").pivot("extractor", list(order)).count()
    first = F.lit(None).cast("string")
    for name in reversed(list(order)):
        first = F.when(F.coalesce(F.col(f"`{name}`"), F.lit(0)) > 0, name).otherwise(first)
    out = registry.select(F.col("id").alias("source_id")).join(counts, "source_id", "left")
    return out.select("source_id", *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(n) for n in order], first.alias("first"))


def finish_inferred(df: DataFrame, cap: int = 60) -> DataFrame:
    """One listing per source, letters-and-digits title and day, the longest description first; then the first cap by start (B12)."""
    key = F.regexp_replace(F.lower(text_or_empty("title")), "[^a-z0-9]", "")
    one = F.row_number().over(Window.partitionBy("source_id", key, F.to_date("start_at")).orderBy(F.length("description").desc(), "start_at", "ord"))
    some = F.row_number().over(Window.partitionBy("source_id").orderBy("start_at", "ord"))
    return df.withColumn("_one", one).where("_one = 1").withColumn("_some", some).where(F.col("_some") <= cap).drop("_one", "_some")


#: Gazetteers up to this many places go into the expression, larger ones are joined.
FEW_TOWNS = 200
#: Fixed patterns: what a title says it is in; a word or a mark of a name.
NAMED = re.compile(r"\bin ([A-Z][a-z]+(?: [A-Z][a-z]+)?)\b")
NAME_PART = re.compile(r"\w+|[^\w\s]")


def town_trie(gazetteer: Sequence[tuple[str, str, str, str]]) -> dict:
    """The gazetteer's names, in small letters, as a trie of their words and marks; an end (key None) holds the name and its first place in the gazetteer."""
    root: dict = {}
    for k, (name, *_) in enumerate(gazetteer):
        node = root
        for part in NAME_PART.findall(name.lower()):
            node = node.setdefault(part, {})
        node.setdefault(None, (name.lower(), k))
    return root


def town_in(text: str, trie: dict, after: str = "") -> int:
    """The place of the first, then longest, name in a text that no word or hyphen goes on; only those after a word, if given; -1 for none."""
    low = text.lower()
    parts = [(m.group(), m.start(), m.end()) for m in NAME_PART.finditer(low)]
    for k, (_, start, _) in enumerate(parts):
        if after and (not k or parts[k - 1][0] != after or parts[k - 1][2] == start):
            continue
        node, found, at = trie, -1, k
        while at < len(parts) and parts[at][0] in node:
            node, end = node[parts[at][0]], parts[at][2]
            at += 1
            name, place = node.get(None, ("", -1))
            if place >= 0 and low[start:end] == name and low[end : end + 1] != "-":
                found = place
        if found >= 0:
            return found
    return -1


def town_index(title: str, head: str, trie: dict) -> int:
    """The town that a description's beginning says it is "in", or that the title names; none for a title "in Elsewhere"."""
    named = NAMED.search(title)
    if named:
        name, node = named.group(1).lower(), trie
        for part in NAME_PART.findall(name):
            node = node.get(part, {})
        if node.get(None, ("",))[0] != name:
            return -1
    found = town_in(head, trie, "in")
    return found if found >= 0 else town_in(title, trie)


def match_towns(df: DataFrame, gazetteer: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Listings that name a known town (town, city, area, state), as "in Town" in the description's first 160 characters or anywhere in the title; a title "in Elsewhere" goes (B13).

    A trie of the names' words, made once and sent to the tasks, is walked from each word of a text, so the work does
    not grow with the gazetteer, a list of places. The first name counts, and the longest that begins there."""
    trie = town_trie(gazetteer)

    def find(titles: pd.Series, heads: pd.Series) -> pd.Series:
        return pd.Series([town_index(t, h, trie) for t, h in zip(titles, heads, strict=True)], dtype="int32")

    found = F.pandas_udf(find, "int")(text_or_empty("title"), F.substring(text_or_empty("description"), 1, 160))
    names = ("city", "area", "state")
    out = df.drop(*names).withColumn("_town", found).where("_town >= 0")
    if len(gazetteer) <= FEW_TOWNS:
        at = F.get(F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, t[1:], strict=True)]) for t in gazetteer]), F.col("_town"))
        return out.withColumns({n: at[n] for n in names}).drop("_town")
    table = df.sparkSession.createDataFrame([(k, *t[1:]) for k, t in enumerate(gazetteer)], "_town int, city string, area string, state string")
    return out.join(table, "_town").drop("_town")


def filter_region(df: DataFrame, box: tuple[float, float, float, float], country: str = "US") -> DataFrame:
    """Rows in the box (south, north, west, east) and country; missing coordinates or country stay (B14)."""
    inside = F.col("lat").between(box[0], box[1]) & F.col("lon").between(box[2], box[3])
    return df.where(F.coalesce(inside, F.lit(True)) & F.coalesce(F.upper(F.col("country")) == country, F.lit(True)))


def home_games(df: DataFrame, local: Sequence[str], team: str) -> DataFrame:
    """Home and neutral games: titles " at " or " @ " go unless the place is local; a leading tag such as [H] goes, the team comes first (B15)."""
    away = F.col("title").rlike(r"(?i) (?:at|@) ")
    here = F.lower(text_or_empty("city")).isin(*[x.lower() for x in local]) | F.lower(text_or_empty("venue")).isin(*[x.lower() for x in local])
    bare = F.trim(F.regexp_replace("title", r"^\s*\[[A-Za-z]\]\s*", ""))
    return df.where(~away | here).withColumn("title", F.when(bare.startswith(team), bare).otherwise(F.concat(F.lit(f"{team} "), bare)))
