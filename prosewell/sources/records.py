"""Semi-structured fields and calendars of event tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed_fields(df: DataFrame, fields: Mapping[str, str], col: str = "props", status: str = "status") -> DataFrame:
    """`df` with a column per field of the JSON text in `col`, and `status`.

    `fields` maps a top-level name to a type. status: `missing` (null or blank text), `malformed` (no JSON, or JSON that is not an object), `mistyped` (some field has a value that is not
    of its type), else `ok`. Fields that are absent or null are null and no fault; so are all fields of rows that are not `ok`. Fields that are not asked for are not read. No
    row is dropped: filter by `status` to keep faulty rows apart.
    """
    text = F.col(f"`{col}`").cast("string")
    blank = text.isNull() | (F.trim(text) == "")
    parsed = df.withColumn("_v", F.when(~blank, F.try_parse_json(text)))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT")), F.lit(False))
    path = {name: f"$['{name}']" for name in fields}
    values = {name: F.try_variant_get("_v", path[name], kind) for name, kind in fields.items()}

    def wrong(name: str) -> Column:
        held = F.try_variant_get("_v", path[name], "variant")
        return held.isNotNull() & ~F.is_variant_null(held) & values[name].isNull()

    mistyped = F.lit(False)
    for name in fields:
        mistyped = mistyped | F.coalesce(wrong(name), F.lit(False))
    state = (
        F.when(blank, "missing").when(~is_object, "malformed").when(mistyped, "mistyped").otherwise("ok")
    )
    judged = parsed.withColumn(status, state)
    ok = F.col(status) == "ok"
    return judged.withColumns({name: F.when(ok, value) for name, value in values.items()}).drop("_v")


def local_time(time: Column, zone: str, source_zone: str = "UTC") -> Column:
    """The wall clock in `zone` at a moment given without a zone, or as one of `source_zone`."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), time.cast("timestamp_ntz"))


def calendar(df: DataFrame, time: str, zone: str, source_zone: str = "UTC") -> DataFrame:
    """`df` with local_date, local_hour, iso_year, iso_week, iso_day, month and quarter of the clock in `zone`; null without a time.

    Daylight saving is that of the zone's rules: an hour may occur twice or not at all, and a local day may have 23 or 25 of them.
    """
    clock = local_time(F.col(f"`{time}`"), zone, source_zone)
    return df.withColumns(
        {
            "local_date": clock.cast("date"),
            "local_hour": F.hour(clock),
            "iso_year": F.extract(F.lit("YEAROFWEEK"), clock),
            "iso_week": F.weekofyear(clock),
            "iso_day": F.weekday(clock) + 1,
            "month": F.month(clock),
            "quarter": F.quarter(clock),
        }
    )
