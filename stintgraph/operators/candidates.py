"""Stage 1: from the nets to candidates, by county, agency type, years and the stricter name net."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUFFER_YEARS, FIRST_END_YEAR = 1, 1950


def in_date_range(start: Column, end: Column, year: Column, as_of: dt.date, buffer: int = BUFFER_YEARS) -> Column:
    """Years overlap, give or take ``buffer``; ends that are missing or before 1950 count as ``as_of``, missing starts never fit."""
    last = F.when(F.year(end) >= FIRST_END_YEAR, F.year(end)).otherwise(as_of.year)
    return F.coalesce((F.year(start) <= year + buffer) & (last >= year - buffer), F.lit(False))


def name_net(prefix: int = 2) -> Column:
    """The same nets on the rows found, stricter with short names: a blank first name stands for ``z``."""
    a, b = F.lower("mention_first_name"), F.lower("post_first_name")
    x, y = F.lower("mention_last_name"), F.lower("post_last_name")
    begin = F.when(a == "", F.lit("z")).otherwise(F.substring(a, 1, prefix))
    one = (F.substring(b, 1, prefix) == begin) & (y == x)
    two = (b == a) & (F.substring(y, 1, prefix) == F.substring(x, 1, prefix))
    return F.coalesce(one | two, F.lit(False))


def _whole(*extra: str) -> Window:
    return Window.partitionBy("mention_id", *extra)


def in_county(county: Column) -> Column:
    """Whether the row's person has any row in ``county``, among the mention's rows. Rows without a person don't."""
    any_row = F.max(F.coalesce(F.col("county") == county, F.lit(False))).over(_whole("post_person_nbr"))
    return any_row & F.col("post_person_nbr").isNotNull()


def has_real_types() -> Column:
    return F.max(F.coalesce(F.upper("post_agency_type") != "POLICE", F.lit(False))).over(_whole())


def select_candidates(net: DataFrame, as_of: dt.date, county: str | None = None) -> DataFrame:
    """``net`` rows that pass county (``county``: the column of the mention's county; skipped where it
    is null or the mention is of corrections), type (only where a mention's rows show more than one),
    years and names, in this order: county and types are judged on all of the net's rows."""
    rows = net
    if county:
        skip = F.col(county).isNull() | (F.upper("mention_agency_type") == "CORRECTIONS")
        rows = rows.withColumn("_here", skip | in_county(F.col(county))).where("_here").drop("_here")
    same = F.lower("post_agency_type") == F.lower("mention_agency_type")
    rows = rows.withColumn("_type", ~has_real_types() | F.coalesce(same, F.lit(False))).where("_type").drop("_type")
    years = in_date_range(F.col("post_start_date"), F.col("post_end_date"), F.col("incident_year"), as_of)
    return rows.where(years & name_net())
