"""Input preparation: ids, years and dates of mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintgraph.functions.names import strip

#: The fields of an id in their order, and forms of dates, the first that reads one counts.
UID_FIELDS = ("first_name", "last_name", "provisional_case_name", "incident_year", "incident_month", "incident_date", "source_agency")
DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "yyyy/M/d", "M-d-yyyy", "yyyy")


def officer_uid(df: DataFrame) -> Column:
    """SHA-256 of the identifying fields, stripped and joined by ``|``; missing ones count as empty."""
    own = [strip(F.coalesce(F.col(f).cast("string"), F.lit(""))) if f in df.columns else F.lit("") for f in UID_FIELDS]
    return F.sha2(F.concat_ws("|", *own), 256)


def recent_year(dates: Column) -> Column:
    """Year of the latest of comma-separated dates; if none can be read, the first 19xx or 20xx in them."""
    parts = F.filter(F.transform(F.split(dates, ","), strip), lambda d: d != "")
    read = F.transform(parts, lambda d: F.coalesce(*(F.try_to_timestamp(d, F.lit(f)) for f in DATE_FORMATS)))
    token = F.regexp_extract(F.array_join(parts, ","), r"\b(?:19|20)\d{2}\b", 0)
    return F.coalesce(F.year(F.array_max(read)), F.when(token != "", token.cast("int")))


def with_incident_year(df: DataFrame) -> DataFrame:
    """``incident_year`` as given, else from ``incident_date``; an error where there is neither."""
    if "incident_year" in df.columns:
        return df
    if "incident_date" not in df.columns:
        raise ValueError("mentions need incident_year or incident_date")
    return df.withColumn("incident_year", recent_year(F.col("incident_date")).cast("string"))


def naive_timestamp(c: Column) -> Column:
    """The wall clock of an ISO time, its offset dropped; null where it can't be read."""
    return F.regexp_replace(strip(c), r"(Z|[+-]\d{2}:?\d{2})$", "").try_cast("timestamp_ntz")


def utc_timestamp(c: Column) -> Column:
    """The same moment in UTC; blank and unreadable become null, each value on its own."""
    return F.to_utc_timestamp(F.try_to_timestamp(F.when(strip(c) != "", strip(c))), F.current_timezone()).cast("timestamp_ntz")


def built_mentions(df: DataFrame, default_state: str | None = None) -> DataFrame:
    """Mentions in their fixed form, one per row with an incident year. ``mention_id`` is made of the row itself
    and its number among equal rows, so it is the same however the rows are dealt out."""
    df = with_incident_year(df)
    same = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    again = F.row_number().over(Window.partitionBy(same).orderBy(F.lit(1)))
    has = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
    blank = lambda c: F.when(c != "", c)
    year = F.col("incident_year").try_cast("double").cast("int")
    rows = df.where(F.coalesce(strip(F.col("incident_year").cast("string")), F.lit("")) != "")
    return rows.select(
        F.xxhash64(same, again).alias("mention_id"),
        F.coalesce(blank(has("officer_uid")), officer_uid(df)).alias("mention_uid"),
        F.upper(has("first_name")).alias("mention_first_name"),
        blank(F.upper(has("middle_name"))).alias("mention_middle_name"),
        F.upper(has("last_name")).alias("mention_last_name"),
        blank(F.upper(has("suffix"))).alias("mention_suffix"),
        blank(has("source_agency")).alias("mention_agency"),
        F.coalesce(blank(has("agency_type")), F.lit("POLICE")).alias("mention_agency_type"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("mention_incident_date"),
        year.alias("incident_year"),
        F.coalesce(blank(has("state")), F.lit(default_state)).alias("state"),
        has("mentioned_agencies").alias("mentioned_agencies"),
    )


def seeded_sample(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Exactly n rows (all, if fewer), drawn by a seed: the least of the digests of seed and row, so that a
    seed gives the same rows however they are dealt out."""
    whole = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *whole)), *whole).limit(n)


def shown_date(c: Column) -> Column:
    """The day of a date, time or ISO text; empty where there is none."""
    return F.coalesce(F.substring(c.cast("string"), 1, 10), F.lit(""))
