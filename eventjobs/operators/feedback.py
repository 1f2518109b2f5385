"""Reports from readers, the corrections they lead to, and the category rules learned from those."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import features, parse_when, text_or_empty
from .filters import shifted, wall

FIELDS = ("category", "when", "venue", "city", "state", "title", "url", "hide")
PLAIN = ("category", "venue", "city", "state", "title", "url")
MIN_SUPPORT, MIN_SHARE = 3, 0.75
KINDS = ("date", "category", "location", "title", "link", "duplicate", "other")
MIN_ELAPSED_MS, PER_HOUR, KEPT_DAYS = 2500, 8, 180


def load_corrections(corrections: DataFrame) -> DataFrame:
    """event and fixes: its applied (decided_at, ord, field, value), oldest first."""
    rows = corrections.where((F.col("decision") == "apply") & F.col("field").isin(*FIELDS) & (text_or_empty("event") != ""))
    fix = F.struct(text_or_empty("decided_at").alias("decided_at"), "ord", "field", text_or_empty("value").alias("value"))
    return rows.groupBy("event").agg(F.array_sort(F.collect_list(fix)).alias("fixes"))


def apply_corrections(events: DataFrame, corrections: DataFrame) -> DataFrame:
    """events (fingerprint, ...) with the last effective value of each field, and corrected; hidden ones go.

    Each field's last value is one aggregate with a map-side part, so a much corrected event does not meet in a list."""
    rows = corrections.where((F.col("decision") == "apply") & F.col("field").isin(*FIELDS) & (text_or_empty("event") != ""))
    order = F.struct(text_or_empty("decided_at").alias("d"), "ord")
    when = parse_when("value")
    last = [F.max_by(F.when((F.col("field") == f) & (text_or_empty("value") != ""), F.col("value")), F.when((F.col("field") == f) & (text_or_empty("value") != ""), order)).alias(f"fix_{f}") for f in PLAIN]
    found = rows.groupBy(F.col("event").alias("fingerprint")).agg(
        *last,
        F.max_by(F.when((F.col("field") == "when"), when), F.when((F.col("field") == "when") & when.isNotNull(), order)).alias("fix_when"),
        F.bool_or(F.col("field") == "hide").alias("hidden"),
        F.bool_or((F.col("field") == "when") | F.col("field").isin(*PLAIN) & (text_or_empty("value") != "")).alias("touched"),
    )
    out = events.join(found, "fingerprint", "left").where(~F.coalesce("hidden", F.lit(False)))
    new = {f: F.coalesce(f"fix_{f}", f) for f in PLAIN if f in events.columns}
    fixed = F.col("fix_when").isNotNull()
    new |= {c: F.when(fixed, F.col(f"fix_when.{c}")).otherwise(F.col(c)) for c in ("start_at", "end_at", "all_day")}
    new["corrected"] = F.coalesce("touched", F.lit(False))
    return out.withColumns(new).drop("hidden", "touched", "fix_when", *[f"fix_{f}" for f in PLAIN])


def verdicts(corrections: DataFrame) -> DataFrame:
    """For each event its last effective category verdict: mistake (was -> value) or confirmation (value null)."""
    value, was = text_or_empty("value"), text_or_empty("was")
    mistake = (F.col("decision") == "apply") & (value != "") & (value != was)
    rows = corrections.where((F.col("field") == "category") & (text_or_empty("event") != "") & (was != "") & (mistake | (F.col("decision") == "reject")))
    fact = F.struct(F.when(mistake, value).alias("to"), was.alias("from"), text_or_empty("title").alias("title"), text_or_empty("source").alias("source"))
    return rows.groupBy("event").agg(F.max_by(fact, F.struct(text_or_empty("decided_at").alias("d"), "ord")).alias("v")).select("event", "v.*")


def rule_counts(verdict: DataFrame) -> DataFrame:
    """feature, from, to, support, evidence and up to five sorted examples: two aggregates over exploded features."""
    one = verdict.select("event", "from", "to", "title", F.explode(features("title", "source")).alias("feature"))
    evidence = one.groupBy("feature", "from").agg(F.count("*").alias("evidence"))
    mistakes = one.where(F.col("to").isNotNull())
    support = mistakes.groupBy("feature", "from", "to").agg(F.count("*").alias("support"))
    # Distinct titles are counted off by rank, which Spark limits before the shuffle; only five of a rule meet in a list.
    titles = mistakes.select("feature", "from", "to", "title").distinct()
    rank = F.row_number().over(Window.partitionBy("feature", "from", "to").orderBy("title"))
    some = titles.withColumn("_rank", rank).where("_rank <= 5").groupBy("feature", "from", "to").agg(F.array_sort(F.collect_list("title")).alias("examples"))
    return support.join(some, ["feature", "from", "to"]).join(evidence, ["feature", "from"])


def learn_rules(verdict: DataFrame, off: DataFrame, support: int = MIN_SUPPORT, share: float = MIN_SHARE) -> DataFrame:
    """key, feature, from, to, support, against, examples, enabled of the rules that have enough support and share."""
    key = F.concat("feature", F.lit(":"), "from", F.lit(">"), "to")
    good = rule_counts(verdict).where((F.col("support") >= support) & (F.col("support") / F.col("evidence") >= share)).withColumn("key", key)
    off = off.where("decision = 'off'").select("key", F.lit(True).alias("off")).distinct()
    out = good.join(off, "key", "left")
    return out.select("key", "feature", "from", "to", "support", (F.col("evidence") - F.col("support")).alias("against"), "examples", F.col("off").isNull().alias("enabled"))


def pending_rules(verdict: DataFrame, rules: DataFrame, top: int = 40) -> DataFrame:
    """Near misses: the top counted (feature, from, to) that are no rule yet."""
    return rule_counts(verdict).join(rules.select("feature", "from", "to"), ["feature", "from", "to"], "left_anti").orderBy(F.desc("support"), "feature", "from", "to").limit(top)


def confusion(verdict: DataFrame) -> DataFrame:
    return verdict.where(F.col("to").isNotNull()).groupBy("from", "to").agg(F.count("*").alias("n"))


def mistakes_by_source(verdict: DataFrame, top: int = 15) -> DataFrame:
    return verdict.where(F.col("to").isNotNull() & (F.col("source") != "")).groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(top)


def apply_learned(events: DataFrame, rules: DataFrame, key: str = "fingerprint") -> DataFrame:
    """events with the category of the strongest enabled rule that fits (support, then key), and learned: the rule's key.

    An equi-join on (feature, category): linear in events times their few features, however many rules there are."""
    enabled = rules.where("enabled").select(F.col("key").alias("rule"), F.col("feature"), F.col("from").alias("category"), "to", "support")
    asked = events.select(key, "category", F.explode(features("title", "source_id")).alias("feature"))
    best = asked.join(enabled, ["feature", "category"]).groupBy(key).agg(F.min(F.struct((-F.col("support")).alias("s"), "rule", "to")).alias("best"))
    out = events.join(best, key, "left")
    return out.withColumn("category", F.coalesce("best.to", "category")).withColumn("learned", F.col("best.rule")).drop("best")


def rule_usage(applied: DataFrame) -> DataFrame:
    return applied.where(F.col("learned").isNotNull()).groupBy(F.col("learned").alias("key")).agg(F.count("*").alias("applied"))


def screen_reports(reports: DataFrame, published: DataFrame, per_hour: int = PER_HOUR) -> DataFrame:
    """Reports of a known kind about published events, without machine-filled ones, at most per_hour of a visitor in a clock hour."""
    good = reports.where((text_or_empty("website") == "") & (F.coalesce("elapsed_ms", F.lit(0)) >= MIN_ELAPSED_MS) & F.col("kind").isin(*KINDS))
    good = good.join(published.select(F.col("fingerprint").alias("event")).distinct(), "event", "left_semi")
    rank = F.row_number().over(Window.partitionBy("visitor", F.date_trunc("hour", "at")).orderBy("at", "id"))
    return good.withColumn("_rank", rank).where(F.col("_rank") <= per_hour).drop("_rank")


def report_values(reports: DataFrame) -> DataFrame:
    """reports with proposed and previous: the suggested and the shown value by kind (value, snapshot structs)."""
    v, s = (lambda f: text_or_empty(F.col(f"value.{f}"))), (lambda f: text_or_empty(F.col(f"snapshot.{f}")))
    joined = lambda *xs: F.array_join(F.filter(F.array(*xs), lambda x: x != ""), ", ")
    span = lambda a, b: F.when(b != "", F.concat(a, F.lit("/"), b)).otherwise(a)
    clock = lambda d, t: F.when((d != "") & (t != ""), F.concat(d, F.lit("T"), t)).otherwise(d)
    kind = F.col("kind")
    proposed = F.when(kind == "date", span(clock(v("date"), v("start")), F.when(v("end") != "", clock(v("date"), v("end"))).otherwise(""))).when(kind == "category", v("category")).when(kind == "location", joined(v("venue"), v("city"), v("state"))).when(kind == "title", v("title")).when(kind == "link", v("url")).otherwise("")
    previous = F.when(kind == "date", span(s("start"), s("end"))).when(kind == "category", s("category")).when(kind == "location", joined(s("venue"), s("city"), s("state"))).when(kind == "title", s("title")).when(kind == "link", s("url")).otherwise("")
    return reports.withColumns({"proposed": proposed, "previous": previous})


def resolve_reports(reports: DataFrame, resolutions: DataFrame, as_of: datetime) -> DataFrame:
    """Correction rows of resolved reports: one for each fix (field, value), or one for the kind's own field."""
    field = F.create_map(*[F.lit(x) for pair in (("date", "when"), ("category", "category"), ("location", "venue"), ("title", "title"), ("link", "url"), ("duplicate", "hide"), ("other", "hide")) for x in pair])
    own = report_values(reports)
    joined = own.join(resolutions.select("id", "decision", "fixes"), "id").select("*", F.explode_outer("fixes").alias("fix"))
    name = F.coalesce("fix.field", field[F.col("kind")])
    return joined.select(
        F.concat("id", F.lit(":"), name).alias("key"), "decision", "event", name.alias("field"), F.coalesce("fix.value", "proposed").alias("value"),
        F.col("previous").alias("was"), F.col("snapshot.title").alias("title"), F.substring(text_or_empty(F.col("snapshot.start")), 1, 10).alias("date"),
        F.col("snapshot.source_id").alias("source"), "kind", F.date_format(wall(as_of), "yyyy-MM-dd'T'HH:mm:ss").alias("decided_at"),
    )


def open_reports(reports: DataFrame, corrections: DataFrame, as_of: datetime) -> DataFrame:
    """Reports not resolved yet, counted by event and kind with their first and last time; older than the keeping time go."""
    done = corrections.select(F.regexp_extract("key", r"^(.*):[^:]*$", 1).alias("id")).distinct()
    rest = reports.join(done, "id", "left_anti").where(F.col("at") >= shifted(wall(as_of), -KEPT_DAYS))
    return rest.groupBy("event", "kind").agg(F.count("*").alias("n"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))
