"""Registered queries over all listings against their SQL on the smallest tables."""

from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

from eventjobs.plans import registered
from eventjobs.plans.bridge import AS_OF

SMALL = "/root/testdata/sf0.001"
WHOLE = ["c10_expand_weekly_all", "c11_recurrence_text_all", "g3_apply_corrections_all", "h2_annual_signal_all", "h7_recurring_view_all"]


@pytest.mark.parametrize("name", WHOLE)
def test_whole_tables(spark, name):
    db = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    frame = registered.queries()[name](spark, SMALL)
    got = Counter(tuple(r) for r in frame.collect())
    answer = db.execute(registered.oracle_sql()[name])
    assert [x[0] for x in answer.description] == frame.columns
    assert got and got == Counter(answer.fetchall())
    if name in ("g3_apply_corrections_all", "h2_annual_signal_all"):
        assert sum(got.values()) == registered.listings(spark, SMALL).count()


def test_rules_expand_for_every_listing(spark):
    days = [date(1998, m, d) for m, d in ((6, 9), (7, 14), (8, 11), (9, 8), (10, 13), (11, 10), (12, 8))]
    begun = [r for r in registered.listings(spark, SMALL).select("ord", "start_at").collect() if r.start_at <= AS_OF]
    got = Counter(tuple(r) for r in registered.queries()["c10_expand_rrule"](spark, SMALL).collect())
    assert got == Counter((r.ord, datetime.combine(day, r.start_at.time())) for r in begun for day in days)
