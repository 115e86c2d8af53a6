"""Typed fields of JSON texts and calendars of other zones."""

import datetime as dt
from zoneinfo import ZoneInfo

from prosewell.sources import records

CASES = [
    ('{"k": 5, "name": "x", "when": "2024-02-03"}', "ok", 5, "x", dt.date(2024, 2, 3)),
    ('{"name": "", "other": [1, {"k": 2}]}', "ok", None, "", None),
    ('{"k": null}', "ok", None, None, None),
    ("{}", "ok", None, None, None),
    ('{"k": "five"}', "mistyped", None, None, None),
    ('{"k": {"k": 5}}', "mistyped", None, None, None),
    ('{"k": 5, "when": "soon"}', "mistyped", None, None, None),
    ('{"k": 5', "malformed", None, None, None),
    ("[1, 2]", "malformed", None, None, None),
    ("17", "malformed", None, None, None),
    ("null", "malformed", None, None, None),
    (" ", "missing", None, None, None),
    ("", "missing", None, None, None),
    (None, "missing", None, None, None),
]


def test_typed_fields(spark):
    rows = [(i, c[0], "clash") for i, c in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, props string, `_w` string")
    found = records.typed_fields(df, {"k": "bigint", "name": "string", "when": "date"})
    assert found.columns == ["id", "props", "_w", "status", "k", "name", "when"]
    got = sorted((r.id, r.status, r.k, r.name, r.when) for r in found.collect())
    assert got == [(i, *c[1:]) for i, c in enumerate(CASES)]
    assert records.typed_fields(df.limit(0), {"k": "bigint"}).count() == 0


def test_calendar_follows_the_zone(spark):
    """Hours around both changes of the clock, the turn of years with 52 and 53 weeks, and no time at all."""
    start = [dt.datetime(2024, 3, 31), dt.datetime(2024, 10, 27), dt.datetime(2020, 12, 31), dt.datetime(2021, 1, 3), dt.datetime(2024, 2, 29)]
    times = [s + dt.timedelta(hours=h, minutes=7) for s in start for h in range(-3, 27)]
    df = spark.createDataFrame([(t,) for t in [*times, None]], "ts timestamp_ntz")
    for zone in ("Europe/Berlin", "America/New_York", "Asia/Kolkata"):
        rows = {r.ts: r for r in records.calendar(df, "ts", zone).collect()}
        for t in times:
            local = t.replace(tzinfo=dt.UTC).astimezone(ZoneInfo(zone))
            year, week, day = local.isocalendar()
            r = rows[t]
            assert (r.local_date, r.local_hour) == (local.date(), local.hour)
            assert (r.iso_year, r.iso_week, r.iso_day) == (year, week, day)
            assert (r.month, r.quarter) == (local.month, (local.month + 2) // 3)
        assert rows[None].local_date is None and rows[None].iso_week is None
