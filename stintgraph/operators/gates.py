"""Gates before and after scoring, best rows, verdicts, sections and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintgraph.functions.names import strip

THRESHOLD = 0.5
#: Texts that reports show.
NO_STATE = "No state provided - cannot safely resolve against all-states table"
NO_CANDIDATES = "No candidates found"
NOT_EXACT = "High similarity score but no exact first+last name match"
AMBIGUOUS = "Multiple distinct persons with exact name match in state - ambiguous (no auto-match)"
SECTIONS = ("✓ Passed ALL gates (auto-match)", "Exact name + above threshold", "Above threshold — name not exact", "Below probability threshold")


def gate(name: str, status: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), status.alias("status"), detail.alias("detail"))


def _gates(*parts: Column) -> Column:
    return F.filter(F.array(*parts), lambda g: g.isNotNull())


def stage0(mentions: DataFrame, common: DataFrame, same_name: DataFrame, require_state: bool = True) -> DataFrame:
    """``mentions`` with gates (array, ending at the first that stops), skip and reason. ``common``:
    last_name, a small fixed list; ``same_name``: mention_id, n."""
    last = F.upper(strip(F.coalesce("mention_last_name", F.lit(""))))
    rows = mentions.withColumn("_last", last).join(common.select(F.col("last_name").alias("_last"), F.lit(True).alias("_common")), "_last", "left")
    rows = rows.join(same_name.withColumnRenamed("n", "_n"), "mention_id", "left")
    n, is_common = F.coalesce("_n", F.lit(0)), F.coalesce("_common", F.lit(False))
    state = F.when(F.col("state") != "", F.col("state"))
    stopped = state.isNull() if require_state else F.lit(False)
    pass_or = lambda bad, what: F.when(bad, what).otherwise("pass")
    gates = _gates(
        gate("State present", pass_or(state.isNull(), "fail"), F.coalesce(state, F.lit("(none)"))) if require_state else F.lit(None).cast("struct<name:string,status:string,detail:string>"),
        F.when(~stopped, gate("Common last name", pass_or(is_common, "flag"), F.when(is_common, F.col("_last")).otherwise(""))),
        F.when(~stopped & ~is_common, gate("Unique name in state", pass_or(n >= 2, "flag"), F.format_string("%d person(s)", n))),
    )
    reason = (
        F.when(stopped, NO_STATE)
        .when(is_common, F.format_string("Common last name (%s) - requires manual verification", F.col("_last")))
        .when(n >= 2, F.format_string("Multiple persons (%d) with same name - needs verification", n))
        .otherwise("")
    )
    return rows.withColumns({"gates": gates, "reason": reason}).withColumn("skip", F.col("reason") != "").drop("_last", "_common", "_n")


def above_threshold(p: Column, threshold: float = THRESHOLD) -> Column:
    return p > threshold


def _plain(c: str) -> Column:
    return F.upper(strip(F.coalesce(F.col(c).cast("string"), F.lit("None"))))


def exact_name() -> Column:
    """First and last names agree but for case and outer white space; null reads as the word None."""
    return (_plain("mention_first_name") == _plain("post_first_name")) & (_plain("mention_last_name") == _plain("post_last_name"))


def ambiguous(candidates: DataFrame, by: str = "mention_id") -> DataFrame:
    """Mentions with two distinct persons or more; rows without a person count as none."""
    return candidates.groupBy(by).agg(F.countDistinct("post_person_nbr").alias("n_persons")).where("n_persons >= 2")


def best(candidates: DataFrame, by: str = "mention_id", order: str = "rec_ord") -> DataFrame:
    """The row of highest probability of each mention, ties by ``order``."""
    first = Window.partitionBy(by).orderBy(F.col("match_probability").desc(), order)
    return candidates.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def is_best(chosen: DataFrame, candidates: DataFrame, by: str = "mention_id") -> DataFrame:
    """``candidates`` with is_best: true for every stint of the chosen person."""
    person = chosen.select(by, F.col("post_person_nbr").alias("_person"))
    return candidates.join(person, by, "left").withColumn("is_best", F.coalesce(F.col("post_person_nbr") == F.col("_person"), F.lit(False))).drop("_person")


def section() -> Column:
    """Number of the candidate's section in SECTIONS, the first that fits."""
    c = lambda n: F.coalesce(F.col(n), F.lit(False))
    both = c("exact_name") & c("above_threshold")
    return F.when(c("is_best") & c("agency_valid") & both, 0).when(both, 1).when(c("above_threshold"), 2).otherwise(3)


def sections(candidates: DataFrame) -> DataFrame:
    """mention_id, section (from 0), title, n, persons (sorted): sections that have candidates."""
    titles = F.array(*map(F.lit, SECTIONS))
    return candidates.withColumn("section", section()).groupBy("mention_id", "section").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("post_person_nbr")), ",").alias("persons")
    ).withColumn("title", F.get(titles, F.col("section")))


def duplicate_rate(rows: DataFrame, key: str) -> DataFrame:
    n, d = F.count(F.lit(1)), F.countDistinct(key)
    return rows.agg(n.alias("n_rows"), d.alias("n_distinct"), F.round((n - d) / n * 100, 6).alias("rate"))
