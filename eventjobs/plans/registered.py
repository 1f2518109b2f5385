"""The registered queries over the given tables, and the same in DuckDB's SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as texts
from ..functions.columns import CATEGORY_RULES, annual_signal, classify_tabling, features, fingerprint, infer_category, norm, series_key, site_of
from ..operators import feedback, filters, recur, reports, resolve, series, trust
from ..sources import extract as ex
from ..sources import feeds
from ..sources.io import written
from . import daily
from .bridge import AS_OF, AS_OF_SQL, VIEWS, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query and its SQL; views are the bridge's that the SQL reads."""

    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = _duck(sql, views)
        return f

    return put


def _duck(sql: str, views: tuple[str, ...]) -> str:
    parts = [f"{v} AS ({VIEWS[v][1].format(**{t: t for t in VIEWS[v][0]})})" for v in views]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join([*parts, body[5:]])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _whole(name: str, of: str, *changes: tuple[str, str]) -> Callable[[Query], Query]:
    """Registers a query over all listings, under its own name and that of the sampled query, whose SQL it has without the sampling."""
    sql = SQL[of]
    for old, new in changes:
        if old not in sql:
            raise ValueError(f"{of}: no {old!r} in its SQL")
        sql = sql.replace(old, new)

    def put(f: Query) -> Query:
        QUERIES[name] = QUERIES[of] = f
        SQL[name] = SQL[of] = sql
        return f

    return put


ALNUM = "regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]', '', 'g')"
FP = f"substr(sha1({ALNUM.format('title')} || '|' || strftime(start_at, '%Y-%m-%d') || '|' || {ALNUM.format('city')}), 1, 16)"
TIER = "CASE WHEN tier IN ('trusted','source','potential') THEN tier WHEN trust = 'high' THEN 'trusted' WHEN trust = 'low' THEN 'source' WHEN category IN ('social','aggregator') THEN 'source' ELSE 'trusted' END"
SITE = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), '^www\\.', '')"
WINDOW = f"start_at BETWEEN {AS_OF_SQL} - INTERVAL 1 DAY AND {AS_OF_SQL} + INTERVAL 200 DAY"
NOT_PUBLIC_SQL = "regexp_matches(title, '(?i)^\\W*(?:[\\w&.''-]+\\s+){0,4}closed\\W*$|\\bclosed for\\b|\\bstaff (?:only|training|meeting)\\b|\\bno school\\b')"
LISTED = "source_id, ord, title, start_at"


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "listings")


@_query("f1_effective_tier", f"SELECT id, {TIER} AS effective_tier FROM registry", ("registry",))
def f1(spark: SparkSession, d: str) -> DataFrame:
    return filters.with_tier(view(spark, d, "registry")).select("id", "effective_tier")


@_query("f2_site_of", f"SELECT id, {SITE} AS site FROM registry", ("registry",))
def f2(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "registry").select("id", site_of("url").alias("site"))


@_query("j11_select_sources", "SELECT id, name, status FROM registry WHERE status = 'active'", ("registry",))
def j11(spark: SparkSession, d: str) -> DataFrame:
    return reports.select_sources(view(spark, d, "registry")).select("id", "name", "status")


@_query("c15_fingerprint", f"SELECT ord, {FP} AS fingerprint FROM listings", ("listings",))
def c15(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select("ord", fingerprint("title", "start_at", "city").alias("fingerprint"))


@_query("c16_tag_from_source", """
SELECT ord, coalesce(nullif(l.state, ''), r.state, '') AS state, coalesce(nullif(l.area, ''), r.area, '') AS area,
  coalesce(nullif(l.city, ''), CASE WHEN NOT contains(coalesce(nullif(l.area, ''), r.area, ''), 'County') THEN coalesce(nullif(l.area, ''), r.area, '') END, '') AS city
FROM listings l LEFT JOIN registry r ON l.source_id = r.id""", ("listings", "registry"))
def c16(spark: SparkSession, d: str) -> DataFrame:
    return filters.tag_from_source(listings(spark, d), view(spark, d, "registry")).select("ord", "state", "area", "city")


def _category_sql() -> str:
    def cases(text: str) -> str:
        out = "CASE"
        for category, words in CATEGORY_RULES:
            escaped = [re.sub(r"([.&/-])", r"\\\1", w).replace("'", "''") for w in words]
            parts = [w if " " in w else f"\\b{w}\\b" for w in escaped]
            out += f" WHEN regexp_matches({text}, '{'|'.join(parts)}') THEN '{category}'"
        return out + " END"

    head = "' ' || substr(lower(description), 1, 400) || ' '"
    return f"SELECT ord, coalesce({cases(chr(39) + ' ' + chr(39) + ' || lower(title) || ' + chr(39) + ' ' + chr(39))}, {cases(head)}, category) AS inferred_category FROM listings"


@_query("c8_infer_category", _category_sql(), ("listings",))
def c8(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select("ord", infer_category("title", "description", "category").alias("inferred_category"))


@_query("e3_norm", "SELECT ord, trim(regexp_replace(lower(title), '[^a-z0-9 ]', '', 'g')) AS norm_title FROM listings", ("listings",))
def e3(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select("ord", norm("title").alias("norm_title"))


@_query("d1_in_window", f"SELECT {LISTED} FROM listings WHERE {WINDOW}", ("listings",))
def d1(spark: SparkSession, d: str) -> DataFrame:
    return filters.in_window(listings(spark, d), AS_OF).select("source_id", "ord", "title", "start_at")


@_query("d2_trim_frequent", f"""
SELECT {LISTED} FROM (SELECT *, count(*) OVER (PARTITION BY source_id, lower(trim(title))) AS n FROM listings)
WHERE n < 20 OR start_at <= {AS_OF_SQL} + INTERVAL 60 DAY""", ("listings",))
def d2(spark: SparkSession, d: str) -> DataFrame:
    return filters.trim_frequent(listings(spark, d), AS_OF).select("source_id", "ord", "title", "start_at")


@_query("d3_drop_not_public", f"SELECT {LISTED} FROM listings WHERE NOT {NOT_PUBLIC_SQL}", ("listings",))
def d3(spark: SparkSession, d: str) -> DataFrame:
    return filters.drop_not_public(listings(spark, d)).select("source_id", "ord", "title", "start_at")


@_query("d4_drop_cancelled", f"SELECT {LISTED} FROM listings WHERE NOT regexp_matches(title, '(?i)\\bcancell?ed\\b|\\bpostponed\\b')", ("listings",))
def d4(spark: SparkSession, d: str) -> DataFrame:
    return filters.drop_cancelled(listings(spark, d)).select("source_id", "ord", "title", "start_at")


def _cache(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Listings of half of the sources as fresh rows, all as a cache a few days old."""
    rows = filters.in_window(listings(spark, d), AS_OF)
    n = F.substring("source_id", 2, 9).cast("int")
    return rows.where(n % 2 == 0), rows.withColumn("snapshot_at", filters.wall(AS_OF) - F.expr("interval '1' day") * (n % 12))


@_query("d5_carry_forward", f"""
WITH w AS (SELECT *, CAST(substr(source_id, 2) AS INTEGER) AS n FROM listings WHERE {WINDOW})
SELECT source_id, ord, FALSE AS carried FROM w WHERE n % 2 = 0
UNION ALL SELECT w.source_id, ord, TRUE FROM w JOIN registry r ON r.id = w.source_id
WHERE w.source_id NOT IN (SELECT source_id FROM w WHERE n % 2 = 0) AND n % 12 <= CASE WHEN r.refresh = 'local' THEN 10 ELSE 6 END AND NOT {NOT_PUBLIC_SQL}""", ("listings", "registry"))
def d5(spark: SparkSession, d: str) -> DataFrame:
    fresh, cache = _cache(spark, d)
    return filters.carry_forward(fresh, cache, view(spark, d, "registry"), AS_OF).select("source_id", "ord", "carried")


@_query("d6_upsert_cache", f"""
WITH w AS (SELECT *, CAST(substr(source_id, 2) AS INTEGER) AS n FROM listings WHERE {WINDOW})
SELECT source_id, ord, {AS_OF_SQL} - INTERVAL 1 DAY * (CASE WHEN n % 2 = 0 THEN 0 ELSE n % 12 END) AS snapshot_at FROM w""", ("listings",))
def d6(spark: SparkSession, d: str) -> DataFrame:
    fresh, cache = _cache(spark, d)
    return filters.upsert_cache(cache, fresh, AS_OF).select("source_id", "ord", "snapshot_at")


@_query("d7_cap_series", f"SELECT {LISTED} FROM listings QUALIFY row_number() OVER (PARTITION BY source_id, title ORDER BY start_at, ord) <= 3", ("listings",))
def d7(spark: SparkSession, d: str) -> DataFrame:
    return filters.cap_series(listings(spark, d), 3).select("source_id", "ord", "title", "start_at")


@_query("d8_dedup_first", f"SELECT {LISTED} FROM listings QUALIFY row_number() OVER (PARTITION BY title, city ORDER BY start_at, ord) = 1", ("listings",))
def d8(spark: SparkSession, d: str) -> DataFrame:
    return filters.dedup_first(listings(spark, d), ["title", "city"], ["start_at", "ord"]).select("source_id", "ord", "title", "start_at")


@_query("b12_finish_inferred", """
WITH one AS (SELECT * FROM listings QUALIFY row_number() OVER (PARTITION BY source_id, regexp_replace(lower(title), '[^a-z0-9]', '', 'g'), CAST(start_at AS DATE) ORDER BY length(description) DESC, start_at, ord) = 1)
SELECT source_id, ord, title, start_at FROM one QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY start_at, ord) <= 60""", ("listings",))
def b12(spark: SparkSession, d: str) -> DataFrame:
    return filters.finish_inferred(listings(spark, d)).select("source_id", "ord", "title", "start_at")


def _extracted(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).withColumn("extractor", F.when(F.col("ord") % 7 == 0, "ics").when(F.substring("source_id", 2, 9).cast("int") % 3 == 0, "jsonld").otherwise("posts"))


ORDER = ("jsonld", "ics", "posts")
EXTRACTED = "ex AS (SELECT *, CASE WHEN ord % 7 = 0 THEN 'ics' WHEN CAST(substr(source_id, 2) AS INTEGER) % 3 = 0 THEN 'jsonld' ELSE 'posts' END AS extractor FROM listings)"


@_query("b19_choose_extractor", f"""
WITH {EXTRACTED}, p AS (SELECT *, CASE extractor WHEN 'jsonld' THEN 1 WHEN 'ics' THEN 2 ELSE 3 END AS place FROM ex)
SELECT source_id, ord, extractor FROM (SELECT *, min(place) OVER (PARTITION BY source_id) AS m FROM p) WHERE place = m""", ("listings",))
def b19(spark: SparkSession, d: str) -> DataFrame:
    return filters.choose_extractor(_extracted(spark, d), ORDER).select("source_id", "ord", "extractor")


@_query("b20_triage", f"""
WITH {EXTRACTED}, c AS (SELECT source_id, count(*) FILTER (WHERE extractor = 'jsonld') AS jsonld, count(*) FILTER (WHERE extractor = 'ics') AS ics, count(*) FILTER (WHERE extractor = 'posts') AS posts FROM ex GROUP BY 1)
SELECT id AS source_id, coalesce(jsonld, 0) AS jsonld, coalesce(ics, 0) AS ics, coalesce(posts, 0) AS posts,
  CASE WHEN jsonld > 0 THEN 'jsonld' WHEN ics > 0 THEN 'ics' WHEN posts > 0 THEN 'posts' END AS first
FROM registry LEFT JOIN c ON id = source_id""", ("listings", "registry"))
def b20(spark: SparkSession, d: str) -> DataFrame:
    return filters.triage(_extracted(spark, d), view(spark, d, "registry"), ORDER)


def merged(spark: SparkSession, d: str) -> DataFrame:
    """Listings in the window, public ones, collapsed by fingerprint, with provenance."""
    rows = filters.drop_not_public(filters.trim_frequent(filters.in_window(listings(spark, d), AS_OF), AS_OF))
    return resolve.collapse_exact(rows, view(spark, d, "registry"))


MERGED = f"""
base AS (SELECT *, {FP} AS fp FROM (SELECT *, count(*) OVER (PARTITION BY source_id, lower(trim(title))) AS n FROM listings WHERE {WINDOW})
  WHERE (n < 20 OR start_at <= {AS_OF_SQL} + INTERVAL 60 DAY) AND NOT {NOT_PUBLIC_SQL}),
reg AS (SELECT id, {TIER} AS tier, {SITE} AS site, name, url AS rurl FROM registry),
ranked AS (SELECT base.*, reg.tier, reg.site, row_number() OVER (PARTITION BY fp ORDER BY start_at, CASE WHEN reg.tier = 'trusted' THEN 0 ELSE 1 END, inferred, -((description <> '')::int + (venue <> '')::int + (image <> '')::int + (price <> '')::int + (end_at IS NOT NULL)::int), ord) AS rk
  FROM base LEFT JOIN reg ON id = source_id),
told AS (SELECT fp, source_id, bool_and(inferred) AS read_only, any_value(coalesce(tier, 'potential')) AS tier, any_value(coalesce(site, source_id)) AS site FROM ranked GROUP BY 1, 2),
ev AS (SELECT fp AS fingerprint, count(*) AS n_sources, bool_or(tier = 'trusted' AND NOT read_only) AS ok, count(DISTINCT site) FILTER (WHERE tier <> 'potential') AS sites, bool_and(tier = 'potential') AS pot, bool_and(read_only) AS ro FROM told GROUP BY 1),
cl AS (SELECT fingerprint, n_sources, CASE WHEN ok OR sites >= 2 THEN 'confirmed' ELSE 'needs-review' END AS verification,
  CASE WHEN ok OR sites >= 2 THEN NULL WHEN pot THEN 'potential source' WHEN ro THEN 'read from page text' ELSE 'single source, not yet corroborated' END AS review_reason FROM ev)"""


@_query("e7_merge_fill", f"""
WITH {MERGED}
SELECT fp AS fingerprint, arg_min(ord, rk) AS ord, arg_min(title, rk) AS title, coalesce(arg_min(nullif(venue, ''), rk) FILTER (WHERE venue <> ''), '') AS venue,
  coalesce(arg_min(url, rk) FILTER (WHERE url <> ''), '') AS url, coalesce(arg_min(description, rk) FILTER (WHERE description <> ''), '') AS description,
  coalesce(arg_min(price, rk) FILTER (WHERE price <> ''), '') AS price, arg_min(end_at, rk) FILTER (WHERE end_at IS NOT NULL) AS end_at,
  CASE WHEN arg_min(category, rk) IN ('other', 'community') THEN coalesce(arg_min(category, rk) FILTER (WHERE category NOT IN ('other', 'community')), arg_min(category, rk)) ELSE arg_min(category, rk) END AS category
FROM ranked GROUP BY 1""", ("listings", "registry"))
def e7(spark: SparkSession, d: str) -> DataFrame:
    return merged(spark, d).select("fingerprint", "ord", "title", "venue", "url", "description", "price", "end_at", "category")


@_query("e8_provenance", f"""
WITH {MERGED}, firsts AS (SELECT fp, source_id, min(rk) AS rk, bool_and(inferred) AS ro FROM ranked GROUP BY 1, 2)
SELECT fp AS fingerprint, string_agg(source_id, ',' ORDER BY rk) AS source_ids, count(*) AS source_count,
  coalesce(string_agg(source_id, ',' ORDER BY source_id) FILTER (WHERE ro), '') AS inferred_sources FROM firsts GROUP BY 1""", ("listings", "registry"))
def e8(spark: SparkSession, d: str) -> DataFrame:
    return merged(spark, d).select("fingerprint", F.array_join("source_ids", ",").alias("source_ids"), F.size("source_ids").cast("long").alias("source_count"), F.array_join(F.array_sort("inferred_sources"), ",").alias("inferred_sources"))


def classified(spark: SparkSession, d: str) -> DataFrame:
    return trust.classify(merged(spark, d), view(spark, d, "registry"), ("fingerprint",))


@_query("f3_classify", f"WITH {MERGED} SELECT fingerprint, verification FROM cl", ("listings", "registry"))
def f3(spark: SparkSession, d: str) -> DataFrame:
    return classified(spark, d).select("fingerprint", "verification")


@_query("f4_review_reason", f"WITH {MERGED} SELECT fingerprint, review_reason FROM cl WHERE review_reason IS NOT NULL", ("listings", "registry"))
def f4(spark: SparkSession, d: str) -> DataFrame:
    return classified(spark, d).where("review_reason is not null").select("fingerprint", "review_reason")


def decisions(spark: SparkSession, d: str) -> DataFrame:
    """A decision for every third listing's fingerprint; the last row by ord counts."""
    rows = listings(spark, d).where("ord % 3 = 0").select(fingerprint("title", "start_at", "city").alias("key"), F.when(F.col("ord") % 2 == 0, "approve").otherwise("reject").alias("decision"), "ord")
    return trust.last_decisions(rows, ("approve", "reject"))


ROUTED = f"""{MERGED},
dec AS (SELECT fp AS key, arg_max(CASE WHEN ord % 2 = 0 THEN 'approve' ELSE 'reject' END, ord) AS decision FROM (SELECT *, {FP} AS fp FROM listings WHERE ord % 3 = 0) GROUP BY 1),
routed AS (SELECT fingerprint, n_sources, CASE WHEN verification = 'confirmed' THEN verification WHEN decision = 'approve' THEN 'reviewed' ELSE verification END AS verification, review_reason,
  CASE WHEN verification = 'confirmed' OR decision = 'approve' THEN 'published' WHEN decision = 'reject' THEN 'dropped' ELSE 'queued' END AS route FROM cl LEFT JOIN dec ON key = fingerprint)"""


@_query("a2_last_decisions", f"SELECT {FP} AS key, arg_max(CASE WHEN ord % 2 = 0 THEN 'approve' ELSE 'reject' END, ord) AS decision FROM listings WHERE ord % 3 = 0 GROUP BY 1", ("listings",))
def a2(spark: SparkSession, d: str) -> DataFrame:
    return decisions(spark, d)


def routed(spark: SparkSession, d: str) -> DataFrame:
    return trust.publish(classified(spark, d), decisions(spark, d))


@_query("f5_publish", f"WITH {ROUTED} SELECT fingerprint, verification, route FROM routed", ("listings", "registry"))
def f5(spark: SparkSession, d: str) -> DataFrame:
    return routed(spark, d).select("fingerprint", "verification", "route")


@_query("f6_review_queue", f"""
WITH {ROUTED} SELECT routed.fingerprint AS key, arg_min(title, rk) AS title, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS source_ids, any_value(review_reason) AS reason
FROM routed JOIN ranked ON fp = fingerprint WHERE route = 'queued' GROUP BY 1""", ("listings", "registry"))
def f6(spark: SparkSession, d: str) -> DataFrame:
    return trust.review_queue(routed(spark, d)).select("key", "title", F.array_join("source_ids", ",").alias("source_ids"), "reason")


@_query("f8_seed_decisions", f"""
WITH {ROUTED}, known AS (SELECT key, decision FROM dec)
SELECT key, decision FROM known UNION ALL SELECT fingerprint, '' FROM routed WHERE route = 'queued' AND fingerprint NOT IN (SELECT key FROM known)""", ("listings", "registry"))
def f8(spark: SparkSession, d: str) -> DataFrame:
    return trust.seed_decisions(trust.review_queue(routed(spark, d)), decisions(spark, d)).select("key", "decision")


@_query("f9_run_stats", f"""
WITH {ROUTED} SELECT count(*) FILTER (WHERE route = 'published' AND verification = 'confirmed') AS confirmed,
  count(*) FILTER (WHERE route = 'published' AND verification = 'confirmed' AND n_sources > 1) AS multi_source,
  count(*) FILTER (WHERE route = 'published' AND verification = 'confirmed' AND n_sources = 1) AS trusted_single,
  count(*) FILTER (WHERE route = 'published' AND verification = 'reviewed') AS reviewed_in,
  count(*) FILTER (WHERE route = 'dropped') AS reviewed_out, count(*) FILTER (WHERE route = 'queued') AS queued FROM routed""", ("listings", "registry"))
def f9(spark: SparkSession, d: str) -> DataFrame:
    return trust.run_stats(routed(spark, d))


@_query("j3_queued_by_source", f"WITH {ROUTED} SELECT source_id, count(*) AS queued FROM routed JOIN told ON fp = fingerprint WHERE route = 'queued' GROUP BY 1", ("listings", "registry"))
def j3(spark: SparkSession, d: str) -> DataFrame:
    return reports.queued_by_source(trust.review_queue(routed(spark, d)))


# feedback

GOOD = "decision = 'apply' AND value <> '' AND value <> was"
VERDICT = f"""v AS (SELECT event, arg_max(CASE WHEN {GOOD} THEN value ELSE '-' END, decided_at || lpad(CAST(ord AS STRING), 20, '0')) AS t,
  arg_max(was, decided_at || lpad(CAST(ord AS STRING), 20, '0')) AS f, arg_max(title, decided_at || lpad(CAST(ord AS STRING), 20, '0')) AS title, arg_max(source, decided_at || lpad(CAST(ord AS STRING), 20, '0')) AS source
  FROM corrections WHERE field = 'category' AND was <> '' AND (({GOOD}) OR decision = 'reject') GROUP BY 1)"""
STOP = "'the','and','for','with','from','this','that','your','our','are','you','all','its','into','over','under','can','new','free','open','day','night','week','weekend','annual','event','events','join','come','more','about','who','what','when','where','how','live','show','series','session','sessions','part'"
WORDS = "list_distinct(list_concat(list_filter(list_transform(regexp_extract_all(lower(title), '([a-z][a-z''&-]{{2,}})', 1), lambda w: regexp_replace(w, '^[''&-]+|[''&-]+$', '', 'g')), lambda w: length(w) >= 3 AND w NOT IN ({stop})), ['source:' || {source}]))"
RULES = f"""{VERDICT},
one AS (SELECT event, t, f, title, unnest({WORDS.format(stop=STOP, source='source')}) AS feature FROM v),
evi AS (SELECT feature, f, count(*) AS evidence FROM one GROUP BY 1, 2),
sup AS (SELECT feature, f, t, count(*) AS support, list_sort(list_distinct(list(title)))[1:5] AS examples FROM one WHERE t <> '-' GROUP BY 1, 2, 3),
rules AS (SELECT feature || ':' || f || '>' || t AS key, feature, f, t, support, evidence - support AS against, examples FROM sup JOIN evi USING (feature, f) WHERE support >= 3 AND support / evidence >= 0.75)"""


def verdict(spark: SparkSession, d: str) -> DataFrame:
    return feedback.verdicts(view(spark, d, "corrections"))


def no_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "key string, decision string")


def rules(spark: SparkSession, d: str) -> DataFrame:
    return feedback.learn_rules(verdict(spark, d), no_rules(spark))


@_query("g5_verdicts", f"WITH {VERDICT} SELECT event, nullif(t, '-') AS \"to\", f AS \"from\", title, source FROM v", ("corrections",))
def g5(spark: SparkSession, d: str) -> DataFrame:
    return verdict(spark, d)


@_query("g6_learn_rules", f"WITH {RULES} SELECT key, feature, f AS \"from\", t AS \"to\", support, against, array_to_string(examples, ';') AS examples, TRUE AS enabled FROM rules", ("corrections",))
def g6(spark: SparkSession, d: str) -> DataFrame:
    return rules(spark, d).withColumn("examples", F.array_join("examples", ";"))


@_query("g7_pending_rules", f"WITH {RULES} SELECT feature, f AS \"from\", t AS \"to\", support, evidence FROM sup JOIN evi USING (feature, f) WHERE feature || ':' || f || '>' || t NOT IN (SELECT key FROM rules) ORDER BY support DESC, feature, f, t LIMIT 40", ("corrections",))
def g7(spark: SparkSession, d: str) -> DataFrame:
    return feedback.pending_rules(verdict(spark, d), rules(spark, d)).select("feature", "from", "to", "support", "evidence")


@_query("g7_confusion", f"WITH {VERDICT} SELECT f AS \"from\", t AS \"to\", count(*) AS n FROM v WHERE t <> '-' GROUP BY 1, 2", ("corrections",))
def g7b(spark: SparkSession, d: str) -> DataFrame:
    return feedback.confusion(verdict(spark, d))


@_query("g7_mistakes_by_source", f"WITH {VERDICT} SELECT source, count(*) AS n FROM v WHERE t <> '-' GROUP BY 1 ORDER BY n DESC, source LIMIT 15", ("corrections",))
def g7c(spark: SparkSession, d: str) -> DataFrame:
    return feedback.mistakes_by_source(verdict(spark, d))


@_query("g4_features", f"SELECT ord, array_to_string(list_sort({WORDS.format(stop=STOP, source='source_id')}), ',') AS features FROM listings", ("listings",))
def g4(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select("ord", F.array_join(F.array_sort(features("title", "source_id")), ",").alias("features"))


LEARNED = f"""{RULES},
asked AS (SELECT ord, category, unnest({WORDS.format(stop=STOP, source='source_id')}) AS feature FROM listings),
best AS (SELECT ord, key, t FROM asked JOIN rules USING (feature) WHERE category = f QUALIFY row_number() OVER (PARTITION BY ord ORDER BY support DESC, key) = 1)"""


@_query("g8_apply_learned", f"WITH {LEARNED} SELECT ord, coalesce(t, category) AS category, key AS learned FROM listings LEFT JOIN best USING (ord)", ("listings", "corrections"))
def g8(spark: SparkSession, d: str) -> DataFrame:
    return feedback.apply_learned(listings(spark, d), rules(spark, d), "ord").select("ord", "category", "learned")


@_query("g9_rule_usage", f"WITH {LEARNED} SELECT key, count(*) AS applied FROM best GROUP BY 1", ("listings", "corrections"))
def g9(spark: SparkSession, d: str) -> DataFrame:
    return feedback.rule_usage(feedback.apply_learned(listings(spark, d), rules(spark, d), "ord"))


@_query("g1_load_corrections", "SELECT event, string_agg(field || '=' || value, ';' ORDER BY decided_at, ord) AS fixes FROM corrections WHERE decision = 'apply' GROUP BY 1", ("corrections",))
def g1(spark: SparkSession, d: str) -> DataFrame:
    return feedback.load_corrections(view(spark, d, "corrections")).select("event", F.array_join(F.transform("fixes", lambda x: F.concat(x["field"], F.lit("="), x["value"])), ";").alias("fixes"))


def _events(spark: SparkSession, d: str, rows: str = "ord % 40 = 1") -> DataFrame:
    """Listings under the fingerprints that corrections name."""
    return listings(spark, d).where(rows).withColumn("fingerprint", F.concat(F.lit("e"), (F.col("ord") % 1500).cast("string")))


@_query("g3_apply_corrections", """
WITH fix AS (SELECT event, arg_max(value, decided_at || lpad(CAST(ord AS STRING), 20, '0')) FILTER (WHERE field = 'category' AND value <> '') AS c, bool_or(field = 'when') AS w FROM corrections WHERE decision = 'apply' GROUP BY 1)
SELECT ord, coalesce(c, category) AS category, CASE WHEN w THEN TIMESTAMP '2026-10-14 10:00:00' ELSE start_at END AS start_at,
  CASE WHEN w THEN TIMESTAMP '2026-10-14 11:00:00' ELSE end_at END AS end_at, CASE WHEN w THEN FALSE ELSE all_day END AS all_day, coalesce(w OR c IS NOT NULL, FALSE) AS corrected
FROM listings LEFT JOIN fix ON event = 'e' || CAST(ord % 1500 AS STRING) WHERE ord % 40 = 1""", ("listings", "corrections"))
def g3(spark: SparkSession, d: str) -> DataFrame:
    return feedback.apply_corrections(_events(spark, d), view(spark, d, "corrections")).select("ord", "category", "start_at", "end_at", "all_day", "corrected")


@_whole("g3_apply_corrections_all", "g3_apply_corrections", (" WHERE ord % 40 = 1", ""))
def g3_all(spark: SparkSession, d: str) -> DataFrame:
    return feedback.apply_corrections(_events(spark, d, "true"), view(spark, d, "corrections")).select("ord", "category", "start_at", "end_at", "all_day", "corrected")


@_query("g10_screen_reports", """
SELECT id, visitor, kind FROM reports WHERE website = '' AND elapsed_ms >= 2500 AND kind <> 'spam' AND event IN (SELECT fingerprint FROM published_keys)
QUALIFY row_number() OVER (PARTITION BY visitor, date_trunc('hour', "at") ORDER BY "at", id) <= 8""", ("reports", "published_keys"))
def g10(spark: SparkSession, d: str) -> DataFrame:
    return feedback.screen_reports(view(spark, d, "reports"), view(spark, d, "published_keys")).select("id", "visitor", "kind")


# series

KEY = """trim(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(title, '(?i)\\b\\d{1,3}(?:st|nd|rd|th)\\s+annual\\b', ' ', 'g'), '\\b(?:19|20)\\d\\d\\b', ' ', 'g')), '[^a-z0-9 ]', ' ', 'g'), '\\b(?:the|annual|presents?|is|back|returns?|celebrat\\w*|edition)\\b', ' ', 'g'), '\\s+', ' ', 'g')) || '|' || trim(regexp_replace(regexp_replace(lower(area), '[^a-z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g'))"""
OCC = f"""ev AS (SELECT *, {KEY} AS key FROM listings),
occ AS (SELECT key, year(start_at) AS year, arg_max(strftime(start_at, '%Y-%m-%d'), strftime(start_at, '%Y-%m-%d %H:%M:%S') || lpad(CAST(ord AS STRING), 20, '0')) AS date, arg_max(url, strftime(start_at, '%Y-%m-%d %H:%M:%S') || lpad(CAST(ord AS STRING), 20, '0')) AS url FROM ev GROUP BY 1, 2)"""


def _published(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).withColumn("source_count", F.lit(1))


@_query("h1_series_key", f"SELECT ord, {KEY} AS key FROM listings", ("listings",))
def h1(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select("ord", series_key("title", "area").alias("key"))


@_query("h2_annual_signal", """
SELECT ord, CAST(nullif(regexp_extract(title, '(?i)\\b(\\d{1,3})(?:st|nd|rd|th)\\s+annual\\b', 1), '') AS INTEGER) AS claimed_number,
  CASE WHEN regexp_matches(title, '(?i)\\b\\d{1,3}(?:st|nd|rd|th)\\s+annual\\b') THEN 'title says "' || regexp_extract(title, '(?i)\\b\\d{1,3}(?:st|nd|rd|th)\\s+annual\\b') || '"' WHEN regexp_matches(title, '(?i)\\bannual\\b') THEN 'title says "annual"' END AS reason
FROM listings WHERE contains(title, 'Annual')""", ("listings",))
def h2(spark: SparkSession, d: str) -> DataFrame:
    return _signals(listings(spark, d).where(F.col("title").contains("Annual")))


@_whole("h2_annual_signal_all", "h2_annual_signal", (" WHERE contains(title, 'Annual')", ""))
def h2_all(spark: SparkSession, d: str) -> DataFrame:
    return _signals(listings(spark, d))


def _signals(rows: DataFrame) -> DataFrame:
    signal = annual_signal("title")
    return rows.select("ord", signal["claimed_number"].alias("claimed_number"), signal["reason"].alias("reason"))


@_query("h3_edition_clusters", f"""
WITH {OCC}, days AS (SELECT DISTINCT key, CAST(start_at AS DATE) AS day FROM ev),
gaps AS (SELECT key, coalesce(day - lag(day) OVER (PARTITION BY key ORDER BY day) > 21, FALSE) AS new FROM days)
SELECT key, CAST(1 + count(*) FILTER (WHERE new) AS BIGINT) AS clusters, count(*) FILTER (WHERE new) >= 1 AS too_frequent FROM gaps GROUP BY 1""", ("listings",))
def h3(spark: SparkSession, d: str) -> DataFrame:
    return series.edition_clusters(_published(spark, d))


def _old(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A history of the listings before as_of, and the later ones as this run's."""
    rows = _published(spark, d)
    before, now = rows.where(F.col("start_at") < filters.wall(AS_OF)), rows.where(F.col("start_at") >= filters.wall(AS_OF))
    old = series.series_rows(before).join(series.edition_clusters(before).select("key", "too_frequent"), "key")
    return old, series.occurrences(before), now


@_query("h4_update_history", f"WITH {OCC} SELECT key, year, date, url FROM occ WHERE year <> 1998 UNION ALL SELECT key, 1998, coalesce(arg_max(strftime(start_at, '%Y-%m-%d'), strftime(start_at, '%Y-%m-%d %H:%M:%S') || lpad(CAST(ord AS STRING), 20, '0')), ''), arg_max(url, strftime(start_at, '%Y-%m-%d %H:%M:%S') || lpad(CAST(ord AS STRING), 20, '0')) FROM ev WHERE year(start_at) = 1998 GROUP BY 1", ("listings",))
def h4(spark: SparkSession, d: str) -> DataFrame:
    return series.update_history(*_old(spark, d))[1].select("key", "year", "date", "url")


@_query("h5_annual_spacing", f"""
WITH {OCC}, g AS (SELECT key, CAST(date AS DATE) - lag(CAST(date AS DATE)) OVER (PARTITION BY key ORDER BY year) AS gap FROM occ)
SELECT key, count(*) AS years, coalesce(bool_or(gap BETWEEN 300 AND 400), FALSE) AS annual FROM g GROUP BY 1""", ("listings",))
def h5(spark: SparkSession, d: str) -> DataFrame:
    return series.annual_spacing(series.occurrences(_published(spark, d)))


@_query("h6_predict_next", f"WITH {OCC} SELECT key, max(date) AS last_date, arg_max(url, year) AS last_url, strftime(CAST(max(date) AS DATE) + INTERVAL 12 MONTH, '%Y-%m-%d') AS predicted FROM occ GROUP BY 1", ("listings",))
def h6(spark: SparkSession, d: str) -> DataFrame:
    return series.predict_next(series.occurrences(_published(spark, d)))


@_query("h7_recurring_view", f"""
WITH {OCC}, rare AS (SELECT * FROM ev WHERE ord % 211 = 3),
o AS (SELECT key, year(start_at) AS year, max(strftime(start_at, '%Y-%m-%d')) AS date FROM rare GROUP BY 1, 2),
days AS (SELECT DISTINCT key, CAST(start_at AS DATE) AS day FROM rare WHERE start_at >= {AS_OF_SQL}),
freq AS (SELECT key FROM (SELECT key, day - lag(day) OVER (PARTITION BY key ORDER BY day) AS gap FROM days) WHERE gap > 21),
g AS (SELECT key, date, CAST(date AS DATE) - lag(CAST(date AS DATE)) OVER (PARTITION BY key ORDER BY year) AS gap FROM o),
s AS (SELECT key, count(*) AS years, coalesce(bool_or(gap BETWEEN 300 AND 400), FALSE) AS annual, max(date) AS last_date FROM g GROUP BY 1),
t AS (SELECT key, arg_max(title, strftime(start_at, '%Y-%m-%d %H:%M:%S') || lpad(CAST(ord AS STRING), 20, '0')) AS title FROM rare GROUP BY 1),
r AS (SELECT key, CASE WHEN length(key) % 7 = 0 THEN 'rejected' WHEN length(key) % 7 = 1 OR years >= 2 AND annual THEN 'confirmed' WHEN regexp_matches(title, '(?i)\\bannual\\b') THEN 'likely' END AS status, years, last_date,
  strftime(CAST(last_date AS DATE) + INTERVAL 12 MONTH, '%Y-%m-%d') AS predicted FROM s JOIN t USING (key) WHERE key NOT IN (SELECT key FROM freq))
SELECT * FROM r WHERE status IS NOT NULL""", ("listings",))
def h7(spark: SparkSession, d: str) -> DataFrame:
    return _recurring(_published(spark, d).where("ord % 211 = 3"))


@_whole("h7_recurring_view_all", "h7_recurring_view", (" WHERE ord % 211 = 3", ""), ("AS key FROM listings", "AS key FROM (SELECT * REPLACE (area || ' lot ' || CAST(ord % 211 AS STRING) AS area) FROM listings)"))
def h7_all(spark: SparkSession, d: str) -> DataFrame:
    """All listings; the area, a part of the series' key, is divided so that series are rare enough to recur yearly."""
    return _recurring(_published(spark, d).withColumn("area", F.concat("area", F.lit(" lot "), (F.col("ord") % 211).cast("string"))))


def _recurring(rows: DataFrame) -> DataFrame:
    now = rows.where(F.col("start_at") >= filters.wall(AS_OF))
    known = series.series_rows(rows).join(series.edition_clusters(now).select("key", "too_frequent"), "key", "left")
    owner = known.select("key", F.when(F.length("key") % 7 == 0, "reject").when(F.length("key") % 7 == 1, "confirm").alias("decision")).where("decision is not null")
    return series.recurring_view(known, series.occurrences(rows), owner).select("key", "status", "years", "last_date", "predicted")


TAB = """CASE WHEN regexp_matches(title, '(?i)farmers?.?s?\\s*market|\\bmeeting\\b') THEN '' ELSE concat_ws(';', CASE WHEN regexp_matches(title, '(?i)\\b(fair|jubilee|community\\s+days?|founders''?\\s+day)\\b') OR regexp_matches(title, '(?i)fest') AND NOT regexp_matches(title, '(?i)manifest|infest') THEN 'Fair / festival' END,
  CASE WHEN regexp_matches(title, '(?i)\\b(expo|health\\s+fair|resource\\s+(day|fair)|job\\s+fair)\\b') THEN 'Expo / health fair / resource day' END, CASE WHEN regexp_matches(title, '(?i)\\b(parade|block\\s+party)\\b') AND NOT regexp_matches(title, '(?i)\\btribute\\b') THEN 'Parade / large public gathering' END) END"""


@_query("i1_classify_tabling", f"SELECT ord, {TAB} AS reasons FROM listings", ("listings",))
def i1(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select("ord", F.array_join(classify_tabling("title"), ";").alias("reasons"))


@_query("i2_tabling_view", f"SELECT ord, strftime(start_at, '%Y-%m') AS month, {TAB} AS reasons FROM listings WHERE start_at >= {AS_OF_SQL} AND {TAB} <> ''", ("listings",))
def i2(spark: SparkSession, d: str) -> DataFrame:
    return series.tabling_view(listings(spark, d), AS_OF).select("ord", "month", F.array_join("reasons", ";").alias("reasons"))


# reports

@_query("j1_stats_snapshot", f"""
WITH {ROUTED}, cat AS (SELECT fp, CASE WHEN arg_min(category, rk) IN ('other', 'community') THEN coalesce(arg_min(category, rk) FILTER (WHERE category NOT IN ('other', 'community')), arg_min(category, rk)) ELSE arg_min(category, rk) END AS category FROM ranked GROUP BY 1),
percat AS (SELECT category, count(*) AS n FROM routed JOIN cat ON fp = fingerprint WHERE route = 'published' GROUP BY 1)
SELECT '1998-06-01' AS date, (SELECT count(*) FROM listings) AS raw, (SELECT count(*) FROM routed) AS merged, (SELECT CAST(sum(n) AS BIGINT) FROM percat) AS published, (SELECT count(*) FROM routed WHERE route = 'queued') AS queued,
  (SELECT count(DISTINCT source_id) FROM listings) AS active_sources, (SELECT string_agg(category || '=' || n, ',' ORDER BY category) FROM percat) AS categories""", ("listings", "registry"))
def j1(spark: SparkSession, d: str) -> DataFrame:
    out = routed(spark, d)
    snap = reports.stats_snapshot(listings(spark, d), out, out, "1998-06-01")
    pairs = F.transform(F.array_sort(F.map_entries("categories")), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return snap.withColumn("categories", F.array_join(pairs, ","))


@_query("j4_source_history", "SELECT source_id, date, events, queued, carried FROM runs QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY date DESC) <= 14", ("runs",))
def j4(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "runs")
    newest = rows.agg(F.max("date")).first()[0]
    now = rows.where(F.col("date") == newest)
    return reports.update_source_history(rows, now.select("source_id", "events", "carried"), now.select("source_id", "queued"), newest)


@_query("j5_promote_sources", f"""
WITH last AS (SELECT source_id, events FROM runs WHERE NOT carried QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY date DESC) <= 7),
good AS (SELECT source_id, count(*) FILTER (WHERE events > 0) AS n FROM last GROUP BY 1)
SELECT id, {TIER} = 'potential' AND autopromote = 'yes' AND coalesce(n, 0) >= 5 AS promoted FROM registry LEFT JOIN good ON id = source_id""", ("runs", "registry"))
def j5(spark: SparkSession, d: str) -> DataFrame:
    return reports.promote_sources(view(spark, d, "registry"), view(spark, d, "runs")).select("id", "promoted")


@_query("j6_sources_view", f"""
WITH last AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY date DESC) <= 7),
a AS (SELECT source_id, string_agg(CAST(events AS STRING), ',' ORDER BY date DESC) AS runs7, arg_max(events, date) AS e, arg_max(queued, date) AS q FROM last GROUP BY 1)
SELECT id, {TIER} AS tier, coalesce(e, 0) AS last_events, coalesce(q, 0) AS last_queued, coalesce(runs7, '') AS runs FROM registry LEFT JOIN a ON id = source_id""", ("runs", "registry"))
def j6(spark: SparkSession, d: str) -> DataFrame:
    return reports.sources_view(view(spark, d, "registry"), view(spark, d, "runs")).select("id", "tier", "last_events", "last_queued", F.array_join(F.transform("runs", lambda x: x.cast("string")), ",").alias("runs"))


QUALITY = """hits AS (SELECT unnest(list_filter([CASE WHEN len(regexp_extract_all(description, '%[0-9A-Fa-f]{2}')) >= 3 THEN 'encoded' END, CASE WHEN regexp_matches(description, '\\{[^{}]*:[^{}]*;[^{}]*\\}') THEN 'css' END,
  CASE WHEN regexp_matches(description, '</?[a-z][a-z0-9]*[\\s>/]|&[a-z]+;|&#\\d+;') THEN 'html' END, CASE WHEN NOT all_day AND strftime(start_at, '%H:%M') = '00:00' THEN 'midnight' END,
  CASE WHEN NOT all_day AND hour(start_at) BETWEEN 1 AND 4 THEN 'small-hours' END, CASE WHEN NOT all_day AND end_at - start_at > INTERVAL 6 DAY THEN 'series-bar' END, CASE WHEN length(trim(title)) < 2 THEN 'no-title' END], lambda x: x IS NOT NULL)) AS "check", source_id FROM listings)"""


@_query("j7_quality_report", f"""
WITH {QUALITY}, percheck AS (SELECT "check", source_id, count(*) AS n FROM hits GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY "check" ORDER BY n DESC, source_id) AS k FROM percheck)
SELECT "check", CAST(sum(n) AS BIGINT) AS events, string_agg(source_id || ' ' || n, ',' ORDER BY k) FILTER (WHERE k <= 4) AS sources FROM r GROUP BY 1""", ("listings",))
def j7(spark: SparkSession, d: str) -> DataFrame:
    return reports.quality_report(listings(spark, d))


@_query("j8_search_events", "SELECT ord, title FROM listings WHERE category = 'music' AND contains(lower(title || ' ' || description || ' ' || venue || ' ' || city || ' ' || area), 'concert') AND contains(lower(title || ' ' || description || ' ' || venue || ' ' || city || ' ' || area), 'brand#1')", ("listings",))
def j8(spark: SparkSession, d: str) -> DataFrame:
    return reports.search_events(listings(spark, d), "Concert brand#1", category="music").select("ord", "title")


@_query("j9_facets", "SELECT 'area' AS facet, area AS value, count(*) AS n FROM listings WHERE area <> '' GROUP BY 2 UNION ALL SELECT 'category', category, count(*) FROM listings GROUP BY 2", ("listings",))
def j9(spark: SparkSession, d: str) -> DataFrame:
    return reports.facets(listings(spark, d))


@_query("j10_category_bars", "SELECT category, count(*) AS n, count(*) / max(count(*)) OVER () AS share FROM listings GROUP BY 1", ("listings",))
def j10(spark: SparkSession, d: str) -> DataFrame:
    return reports.category_bars(listings(spark, d))


@_query("j12_run_report", f"""
WITH {EXTRACTED}, c AS (SELECT source_id, count(*) AS n, min(extractor) AS extractor FROM ex WHERE {WINDOW} GROUP BY 1)
SELECT id AS source_id, coalesce(n, 0) AS events, coalesce(extractor, '') AS extractor, FALSE AS carried FROM registry LEFT JOIN c ON id = source_id""", ("listings", "registry"))
def j12(spark: SparkSession, d: str) -> DataFrame:
    return reports.run_report(view(spark, d, "registry"), filters.in_window(_extracted(spark, d), AS_OF).withColumn("carried", F.lit(False)))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is published on the tables, confirmed by whom."""
    return routed(spark, sf_dir).where("route = 'published'").select("fingerprint", "title", "start_at", "category", "verification", F.array_join("source_ids", ",").alias("source_ids"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# cleaning and recurrence

DAY = AS_OF.date()


def pages(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url", "html")


@_query("c1_clean_text", r"SELECT doc_id, trim(regexp_replace(text, '[ \t\n\v\f\r\x1c-\x1f]+', ' ', 'g')) AS cleaned FROM documents WHERE NOT regexp_matches(text, '&|[^\x00-\x7F]')")
def c1(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.where(~F.col("text").rlike(r"&|[^\x00-\x7F]")).select("doc_id", texts.clean_text("text").alias("cleaned"))


@_query("c1_clean_pages")
def c1p(spark: SparkSession, d: str) -> DataFrame:
    """Rows only: entities and compatibility forms are not expressible in SQL; tests hold the helper against cases."""
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", texts.clean_text("text").alias("cleaned"))


@_query("c2_html_to_text")
def c2(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("page_id", texts.html_to_text("html").alias("text"))


@_query("c3_clean_description")
def c3(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select("ord", texts.clean_description("description", "title").alias("description"))


@_query("c4_truncate_desc")
def c4(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", texts.truncate_desc("text", 200).alias("text"))


@_query("c7_time_from_text", "SELECT ord, CAST((8 + ord % 12) * 60 AS INTEGER) AS minutes FROM listings", ("listings",))
def c7(spark: SparkSession, d: str) -> DataFrame:
    hour = 8 + F.col("ord") % 12
    text = F.concat("title", F.lit(" doors "), F.when(hour > 12, hour - 12).otherwise(hour).cast("string"), F.when(hour >= 12, " PM").otherwise(" a.m."))
    return listings(spark, d).select("ord", texts.time_from_text(text).alias("minutes"))


@_query("b6_find_dates", "SELECT ord, CASE WHEN NOT ends_with(title, 'closed') THEN strftime(start_at + INTERVAL 336 MONTH, '%Y-%m-%d') END AS start FROM listings", ("listings",))
def b6(spark: SparkSession, d: str) -> DataFrame:
    said = F.concat("title", F.lit(" on "), F.date_format(F.add_months("start_at", 336), "MMMM d, yyyy"), F.lit(" at the hall"))
    return listings(spark, d).select("ord", F.get(texts.find_dates(said, F.lit(DAY)), F.lit(0))["start"].cast("string").alias("start"))


@_query("b7_find_time", "SELECT ord, CAST(CASE WHEN ord % 12 + 1 = 12 THEN 12 ELSE ord % 12 + 13 END * 60 AS INTEGER) AS minutes FROM listings", ("listings",))
def b7(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).select("ord", texts.find_time(F.concat("title", F.lit(" "), (F.col("ord") % 12 + 1).cast("string"), F.lit(":00 p.m."))).alias("minutes"))


@_query("c5_parse_wall_time", "SELECT ord, start_at AS parsed, timezone('America/Chicago', timezone('UTC', start_at)) AS instant FROM listings", ("listings",))
def c5(spark: SparkSession, d: str) -> DataFrame:
    iso = F.date_format("start_at", "yyyy-MM-dd'T'HH:mm:ss")
    return listings(spark, d).select("ord", ex.parse_wall_time(iso, AS_OF).alias("parsed"), ex.parse_wall_time(F.concat(iso, F.lit("Z")), AS_OF).alias("instant"))


@_query("c6_from_epoch", "SELECT ord, timezone('America/Chicago', to_timestamp(epoch(start_at))) AS wall FROM listings", ("listings",))
def c6(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.columns import from_epoch

    return listings(spark, d).select("ord", from_epoch(F.unix_timestamp(F.col("start_at").cast("timestamp"))).alias("wall"))


@_query("c9_map_category", "SELECT ord, CASE WHEN contains(lower(title), 'fest') THEN 'community' WHEN contains(lower(title), 'concert') THEN 'music' WHEN contains(lower(title), 'shop') THEN 'education' ELSE 'other' END AS category FROM listings", ("listings",))
def c9(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.columns import map_category

    return listings(spark, d).select("ord", map_category("title", (("fest", "community"), ("concert", "music"), ("shop", "education"))).alias("category"))


@_query("c10_expand_weekly", f"""
WITH base AS (SELECT ord, start_at, CASE WHEN ord % 3 = 0 THEN 1 ELSE 7 END * (1 + ord % 2) AS step FROM listings WHERE start_at <= {AS_OF_SQL} AND ord % 5 = 1),
n AS (SELECT ord, start_at, step, unnest(range(0, 61)) AS k, CAST(greatest(0, ceil((DATE '1998-06-01' - CAST(start_at AS DATE)) / step)) AS BIGINT) AS skipped FROM base)
SELECT ord, start_at + INTERVAL 1 DAY * ((skipped + k) * step) AS start_at FROM n WHERE k < 60 AND CAST(start_at AS DATE) + CAST((skipped + k) * step AS INTEGER) <= DATE '1998-06-01' + 60""", ("listings",))
def c10(spark: SparkSession, d: str) -> DataFrame:
    return _weekly(listings(spark, d).where((F.col("start_at") <= filters.wall(AS_OF)) & (F.col("ord") % 5 == 1)))


@_whole("c10_expand_weekly_all", "c10_expand_weekly", (" AND ord % 5 = 1", ""))
def c10_all(spark: SparkSession, d: str) -> DataFrame:
    return _weekly(listings(spark, d).where(F.col("start_at") <= filters.wall(AS_OF)))


def _weekly(rows: DataFrame) -> DataFrame:
    ruled = rows.select("ord", "start_at", "end_at", F.when(F.col("ord") % 3 == 0, "DAILY").otherwise("WEEKLY").alias("freq"), (1 + F.col("ord") % 2).cast("int").alias("interval"), F.lit(None).cast("timestamp_ntz").alias("until"))
    return recur.expand_weekly(ruled, DAY).select("ord", "start_at")


@_query("c10_expand_rrule")
def c10r(spark: SparkSession, d: str) -> DataFrame:
    rows = listings(spark, d).where(F.col("start_at") <= filters.wall(AS_OF))
    ruled = rows.select("ord", "start_at", "end_at", F.lit("FREQ=MONTHLY;BYDAY=2TU").alias("rule"), F.array().cast("array<timestamp_ntz>").alias("exdates"))
    return recur.expand_rrule(ruled, AS_OF).select("ord", "start_at")


@_query("c11_recurrence_text", """
WITH base AS (SELECT ord, CAST(start_at AS DATE) AS f FROM listings WHERE start_at <= TIMESTAMP '1998-06-01 06:00:00' AND ord % 40 = 1),
d AS (SELECT ord, f, CAST(x AS DATE) AS day FROM base, (SELECT unnest(generate_series(DATE '1998-06-01', DATE '1998-12-18', INTERVAL 1 DAY)) AS x))
SELECT ord, CAST(day AS STRING) AS day FROM d WHERE CASE ord % 4 WHEN 1 THEN dayname(day) IN ('Tuesday', 'Saturday') AND ((day - (f - (isodow(f) - 1)::INTEGER)) // 7) % 2 = 0
  WHEN 3 THEN dayname(day) = 'Friday' AND month(day + 7) <> month(day) ELSE dayofmonth(day) = 15 END""", ("listings",))
def c11(spark: SparkSession, d: str) -> DataFrame:
    return _said(listings(spark, d).where((F.col("start_at") <= filters.wall(AS_OF)) & (F.col("ord") % 40 == 1)))


@_whole("c11_recurrence_text_all", "c11_recurrence_text", (" AND ord % 40 = 1", ""))
def c11_all(spark: SparkSession, d: str) -> DataFrame:
    return _said(listings(spark, d).where(F.col("start_at") <= filters.wall(AS_OF)))


def _said(rows: DataFrame) -> DataFrame:
    says = F.when(F.col("ord") % 4 == 1, "Recurring every 2 weeks on Tuesday, Saturday").when(F.col("ord") % 4 == 3, "monthly on the last friday").otherwise("Monthly on day 15")
    return recur.expand_recurrence_text(rows.select("ord", says.alias("recurrence"), F.to_date("start_at").alias("first"), F.lit(None).cast("date").alias("last")), DAY).select("ord", F.col("day").cast("string").alias("day"))


@_query("c12_date_runs", """
WITH days AS (SELECT DISTINCT title, CAST(start_at AS DATE) AS day FROM listings), g AS (SELECT title, day, day - CAST(row_number() OVER (PARTITION BY title ORDER BY day) AS INTEGER) AS island FROM days)
SELECT title, CAST(min(day) AS STRING) AS first, CAST(max(day) AS STRING) AS last FROM g GROUP BY title, island""", ("listings",))
def c12(spark: SparkSession, d: str) -> DataFrame:
    return recur.date_runs(listings(spark, d).withColumn("date", F.to_date("start_at")), ["title"], "date").select("title", F.col("first").cast("string").alias("first"), F.col("last").cast("string").alias("last"))


@_query("c13_fix_midnight", """
WITH x AS (SELECT ord, start_at, end_at, all_day, NOT all_day AND strftime(start_at, '%H:%M') = '00:00' AS doubt, end_at IS NOT NULL AND strftime(end_at, '%H:%M') = '00:00' AND CAST(end_at AS DATE) > CAST(start_at AS DATE) AS zero FROM listings)
SELECT ord, start_at, CASE WHEN doubt AND zero AND end_at - INTERVAL 1 SECOND > start_at THEN end_at - INTERVAL 1 SECOND WHEN doubt AND (zero OR end_at IS NULL OR end_at = start_at) THEN NULL ELSE end_at END AS end_at,
  all_day OR doubt AND (zero OR end_at IS NULL OR end_at = start_at) AS all_day FROM x""", ("listings",))
def c13(spark: SparkSession, d: str) -> DataFrame:
    return recur.fix_midnight(listings(spark, d)).select("ord", "start_at", "end_at", "all_day")


@_query("c14_fix_series_span", """
SELECT ord, CASE WHEN end_at >= start_at AND NOT (NOT all_day AND end_at > start_at + INTERVAL 6 DAY AND contains(description, 'weekly')) THEN end_at END AS end_at FROM listings""", ("listings",))
def c14(spark: SparkSession, d: str) -> DataFrame:
    return recur.fix_series_span(listings(spark, d)).select("ord", "end_at")


def _normalize_sql() -> str:
    """The parts' SQL after one another: descriptions, categories, spans and then midnights."""
    said = "CASE WHEN starts_with(description, 'A%20') THEN 'A night of music' WHEN starts_with(description, '<b>') THEN 'Doors open & more' WHEN starts_with(description, '.x ') THEN 'story' ELSE description END"
    return f"""
WITH said AS (SELECT * REPLACE ({said} AS description) FROM listings), found AS ({_category_sql().replace("FROM listings", "FROM said")}),
spans AS (SELECT ord, title, description, start_at, all_day, CASE WHEN category IN ('other', 'community') THEN inferred_category ELSE category END AS category,
  CASE WHEN end_at >= start_at AND NOT (NOT all_day AND end_at > start_at + INTERVAL 6 DAY AND contains(description, 'weekly')) THEN end_at END AS end_at FROM said JOIN found USING (ord)),
x AS (SELECT *, NOT all_day AND strftime(start_at, '%H:%M') = '00:00' AS doubt, coalesce(strftime(end_at, '%H:%M') = '00:00' AND CAST(end_at AS DATE) > CAST(start_at AS DATE), FALSE) AS zero FROM spans)
SELECT ord, title, description, category, start_at, CASE WHEN doubt AND zero AND end_at - INTERVAL 1 SECOND > start_at THEN end_at - INTERVAL 1 SECOND WHEN doubt AND (zero OR end_at IS NULL OR end_at = start_at) THEN NULL ELSE end_at END AS end_at,
  all_day OR doubt AND (zero OR end_at IS NULL OR end_at = start_at) AS all_day FROM x"""


@_query("c17_normalize", _normalize_sql(), ("listings",))
def c17(spark: SparkSession, d: str) -> DataFrame:
    return recur.normalize(listings(spark, d)).select("ord", "title", "description", "category", "start_at", "end_at", "all_day")


# extraction from payloads that Spark makes of the listings, so that the listing is the expected result

def _bodies(spark: SparkSession, d: str) -> DataFrame:
    iso = F.date_format("start_at", "yyyy-MM-dd'T'HH:mm:ss")
    node = F.struct(F.lit("MusicEvent").alias("@type"), F.col("title").alias("name"), iso.alias("startDate"), F.struct(F.col("venue").alias("name"), F.struct(F.col("city").alias("addressLocality")).alias("address")).alias("location"), F.struct(F.lit("0").alias("price")).alias("offers"))
    page = F.concat(F.lit('<html><head><script type="application/ld+json">{"@graph":['), F.to_json(node), F.lit("]}</script></head><body><p>x</p></body></html>"))
    return filters.in_window(listings(spark, d), AS_OF).select("ord", "title", "venue", "city", "start_at", page.alias("html"))


@_query("b1_extract_jsonld", f"SELECT ord AS page_id, title, venue, city, start_at, 'Free' AS price FROM listings WHERE {WINDOW}", ("listings",))
def b1(spark: SparkSession, d: str) -> DataFrame:
    found = ex.extract_jsonld(_bodies(spark, d).select(F.col("ord").alias("page_id"), F.lit("https://a.example/").alias("url"), "html"))
    return found.select("page_id", "title", "venue", "city", ex.parse_wall_time("start_text", AS_OF).alias("start_at"), "price")


@_query("b3_extract_ics", f"SELECT CAST(ord AS STRING) AS uid, title, venue, start_at FROM listings WHERE {WINDOW}", ("listings",))
def b3(spark: SparkSession, d: str) -> DataFrame:
    rows = filters.in_window(listings(spark, d), AS_OF)
    item = F.concat(F.lit("BEGIN:VEVENT\r\nUID:"), F.col("ord").cast("string"), F.lit("\r\nSUMMARY:"), F.substring("title", 1, 6), F.lit("\r\n "), F.expr("substring(title, 7)"), F.lit("\r\nDTSTART:"), F.date_format("start_at", "yyyyMMdd'T'HHmmss"), F.lit("\r\nLOCATION:"), F.col("venue"), F.lit("\\, Main St\r\nEND:VEVENT\r\n"))
    found = ex.extract_ics(rows.select(F.col("ord").alias("source_id"), F.lit("").alias("url"), item.alias("body")))
    return found.select("uid", "title", "venue", ex.parse_compact("start_text").alias("start_at"))


@_query("b5_map_json_feed", f"SELECT ord AS source_id, title, venue, city, start_at FROM listings WHERE {WINDOW} AND NOT starts_with(title, 'CANCELLED')", ("listings",))
def b5(spark: SparkSession, d: str) -> DataFrame:
    rows = filters.in_window(listings(spark, d), AS_OF)
    record = F.struct("title", F.date_format("start_at", "yyyy-MM-dd HH:mm:ss").alias("start_date"), F.struct("venue", "city").alias("venue"), F.when(F.col("title").startswith("CANCELLED"), "canceled").otherwise("scheduled").alias("status"))
    payloads = rows.select(F.col("ord").alias("source_id"), F.to_json(F.struct(F.array(record).alias("events"))).alias("body"))
    return feeds.map_json_feed(payloads, feeds.PRESETS["tribe"], AS_OF).select("source_id", "title", "venue", "city", "start_at")


@_query("b10_html_blocks")
def b10(spark: SparkSession, d: str) -> DataFrame:
    return ex.html_blocks(pages(spark, d))


@_query("b11_extract_prose")
def b11(spark: SparkSession, d: str) -> DataFrame:
    return ex.extract_prose(pages(spark, d), AS_OF)


@_query("b16_candidate_links")
def b16(spark: SparkSession, d: str) -> DataFrame:
    return ex.candidate_links(pages(spark, d))


@_query("b17_discover_feeds")
def b17(spark: SparkSession, d: str) -> DataFrame:
    return ex.discover_feeds(pages(spark, d))


@_query("b18_thin_pages")
def b18(spark: SparkSession, d: str) -> DataFrame:
    return ex.thin_pages(pages(spark, d))


@_query("k1_daily_run")
def k1(spark: SparkSession, d: str) -> DataFrame:
    """What a whole run publishes; its parts have SQL of their own."""
    old, seen, _ = _old(spark, d)
    rows = written(recur.normalize(filters.tag_from_source(listings(spark, d), view(spark, d, "registry"))))
    empty = rows.where("false").withColumn("snapshot_at", filters.wall(AS_OF))
    out = daily.daily_run(daily.Inputs(rows, view(spark, d, "registry"), empty, decisions(spark, d), view(spark, d, "corrections"), no_rules(spark), old, seen), AS_OF)
    return out.published.select("fingerprint", "title", "start_at", "category", "verification", "tabling", "corrected")
