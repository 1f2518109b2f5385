"""JSON feeds to listings by a declared field map, in Spark's own expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import from_epoch
from .extract import parse_wall_time


@dataclass(frozen=True)
class FeedSpec:
    """Where a feed's records are and, for each listing field, the paths of which the first that is not blank counts.

    start and end are (paths, kind): iso, seconds or millis, or clock for a day's path and a time's. address: paths joined by commas. skip: (path, values) whose records go."""

    records: str
    fields: dict[str, Sequence[str]]
    start: tuple[Sequence[str], str]
    end: tuple[Sequence[str], str] = ((), "iso")
    address: Sequence[str] = ()
    skip: Sequence[tuple[str, Sequence[str]]] = ()


# Field maps of well-known feed layouts.
PRESETS = {
    "tribe": FeedSpec("events", {"title": ("title",), "venue": ("venue.venue", "venue[0].venue"), "city": ("venue.city", "venue[0].city"), "url": ("url",), "description": ("description", "excerpt"), "price": ("cost",), "image": ("image.url",)}, (("start_date",), "iso"), (("end_date",), "iso"), ("venue.address", "venue.city", "venue.state"), (("status", ("canceled", "cancelled")),)),
    "squarespace": FeedSpec("upcoming", {"title": ("title",), "venue": ("location.addressTitle",), "url": ("fullUrl",), "description": ("excerpt", "body"), "image": ("assetUrl",)}, (("startDate",), "millis"), (("endDate",), "millis"), ("location.addressLine1", "location.addressLine2")),
    "nps": FeedSpec("data", {"title": ("title",), "venue": ("location",), "url": ("infourl", "regresurl"), "description": ("description",), "price": ("feeinfo",)}, (("datestart", "date"), "iso"), (("dateend",), "iso")),
    "weblink": FeedSpec("Events", {"title": ("EventName",), "venue": ("Venue", "Address1"), "city": ("City",), "state": ("State",), "description": ("Descr", "ShortDescr"), "image": ("ImageUrl",)}, (("StartDate", "StartTime"), "clock"), (("EndDate", "EndTime"), "clock"), ("Address1", "Address2", "City", "State")),
    "mycalendar": FeedSpec("events", {"title": ("event_title",), "venue": ("event_label", "event_location_name"), "city": ("event_city",), "state": ("event_state",), "url": ("event_link", "event_url"), "description": ("event_desc", "event_short"), "image": ("event_image",)}, (("occur_begin", "event_begin"), "iso"), (("occur_end",), "iso"), ("event_street", "event_street2", "event_city", "event_state")),
    "evvnt": FeedSpec("rawEvents", {"title": ("title",), "venue": ("venue.name",), "city": ("venue.town",), "url": ("source_broadcast_url",), "description": ("description", "summary"), "lat": ("venue.latitude",), "lon": ("venue.longitude",), "country": ("venue.country",), "zip": ("venue.post_code",)}, (("start_time", "start_date"), "iso"), (("end_time",), "iso"), ("venue.address_1", "venue.address_2")),
    "agile": FeedSpec("ArrayOfEvent", {"title": ("Name",), "venue": ("Venue.Name",), "city": ("Venue.City",), "url": ("InfoLink", "BuyLink"), "description": ("ShortDescription",), "image": ("EventImage",)}, (("StartDate",), "iso"), (("EndDate",), "iso"), ("Venue.Address1", "Venue.City", "Venue.State"), (("DateTBD", ("true",)),)),
    "eventbrite": FeedSpec("events", {"title": ("name.text", "name"), "venue": ("primary_venue.name", "venue.name"), "city": ("primary_venue.address.city",), "url": ("url",), "description": ("summary",), "image": ("image.url",)}, (("start.local", "start_date"), "iso"), (("end.local", "end_date"), "iso"), ("primary_venue.address.address_1", "primary_venue.address.city"), (("is_online_event", ("true",)), ("is_cancelled", ("true",)))),
}


def map_json_feed(payloads: DataFrame, spec: FeedSpec, as_of: datetime) -> DataFrame:
    """payloads (source_id, body) -> a listing for each record; bodies that are no JSON give no rows, records without a title or start go."""
    body = F.try_parse_json("body")
    records = payloads.select("source_id", F.try_variant_get(body, f"$.{spec.records}", "array<variant>").alias("r")).select("source_id", F.posexplode("r").alias("n", "v"))

    def first(paths: Sequence[str]) -> Column:
        found = [F.nullif(F.trim(F.try_variant_get("v", f"$.{p}", "string")), F.lit("")) for p in paths]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    def when(where: tuple[Sequence[str], str]) -> Column:
        if where[1] == "clock":
            day, clock = (first([p]) for p in where[0])
            return parse_wall_time(F.coalesce(F.concat_ws(" ", F.substring(day, 1, 10), clock), F.lit("")), as_of)
        value = first(where[0])
        if where[1] == "iso":
            return parse_wall_time(F.coalesce(value, F.lit("")), as_of)
        return from_epoch(value.try_cast("long"), "ms" if where[1] == "millis" else "s")

    out = records
    for path, values in spec.skip:
        out = out.where(~F.coalesce(F.lower(F.try_variant_get("v", f"$.{path}", "string")).isin(*values), F.lit(False)))
    fields = {c: F.coalesce(first(p), F.lit("")) for c, p in spec.fields.items()}
    address = F.array_join(F.filter(F.array(*[first([p]) for p in spec.address]), lambda x: x.isNotNull()), ", ") if spec.address else F.lit("")
    return out.select("source_id", "n", *[v.alias(c) for c, v in fields.items()], address.alias("address"), when(spec.start).alias("start_at"), when(spec.end).alias("end_at")).where((F.col("title") != "") & F.col("start_at").isNotNull())


def parse_city_line(column: Column | str) -> Column:
    """struct(city, state, zip) of a line such as 'Duluth, MN 55802'; nulls where it is not one."""
    text = F.col(column) if isinstance(column, str) else column
    part = lambda n: F.nullif(F.regexp_extract(text, r"^\s*([A-Za-z .'-]+),\s*([A-Z]{2})(?:\s+(\d{5})(?:-\d{4})?)?\s*$", n), F.lit(""))
    return F.struct(part(1).alias("city"), part(2).alias("state"), part(3).alias("zip"))


def state_of(zip_code: Column | str, towns: dict[str, str] | None = None, town: Column | str | None = None, region: Column | str | None = None) -> Column:
    """The state from the ZIP's first digits, else from a small town table, else from the region's text."""
    z = F.col(zip_code) if isinstance(zip_code, str) else zip_code
    by_zip = F.when(z.rlike("^5(?:50|51|53|54|55|56|57|58|59|60|61|62|63|64|65|66|67)"), "MN").when(z.rlike("^5[34]"), "WI").when(z.rlike("^4[89]"), "MI")
    by_town = F.create_map(*[F.lit(x) for pair in towns.items() for x in pair])[F.lower(F.col(town) if isinstance(town, str) else town)] if towns and town is not None else F.lit(None).cast("string")
    text = F.lower(F.col(region) if isinstance(region, str) else region) if region is not None else F.lit("")
    by_region = F.when(text.contains("minnesota") | (text == "mn"), "MN").when(text.contains("wisconsin") | (text == "wi"), "WI").when(text.contains("michigan") | (text == "mi"), "MI")
    return F.coalesce(by_zip, by_town, by_region, F.lit(""))
