"""Sources and sinks: the driver's star-schema tables seen as employment and mentions, CSV and JSON
files, routed outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintgraph.functions.names import feature_columns, strip
from stintgraph.functions.prepare import built_mentions, seeded_sample


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _second(c: str) -> Column:
    return F.split_part(F.col(c), F.lit(" "), F.lit(2))


def with_keys(employment: DataFrame) -> DataFrame:
    """Normal forms that joins and pushed-down filters need, to be stored with the table."""
    first, last = F.lower("post_first_name"), F.lower("post_last_name")
    return employment.withColumns({"fn_lc": first, "ln_lc": last, "fn2": F.substring(first, 1, 2), "ln2": F.substring(last, 1, 2)})


def employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employment records made of orders, their customers and parts; ``rec_ord`` is the primary key."""
    t = lambda n: table(spark, sf_dir, n)
    ends = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("max_ship"))
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    people = t("customer").select("c_custkey", "c_nationkey").join(t("part").select("p_partkey", "p_name", "p_brand"), F.col("c_custkey") == F.col("p_partkey"))
    people = people.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").join(people, F.col("o_custkey") == F.col("c_custkey")).join(ends, "o_orderkey", "left")
    status = F.col("o_orderstatus")
    kind = F.when(status == "F", " Police Department").when(status == "O", " Sheriff Office").otherwise(" Corrections")
    return with_keys(rows.select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("post_person_nbr"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("post_first_name"),
        F.lit("").alias("post_middle_name"),
        F.concat(_second("p_name"), F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("post_last_name"),
        F.lit("").alias("post_suffix"),
        F.concat("n_name", kind).alias("post_agency_name"),
        F.when(status == "P", "CORRECTIONS").otherwise("POLICE").alias("post_agency_type"),
        F.col("o_orderdate").alias("post_start_date"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("max_ship")).alias("post_end_date"),
        F.lower("n_name").alias("state"),
        F.col("r_name").alias("county"),
        F.col("o_orderkey").alias("rec_ord"),
    ))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions made of customers and parts; ``mention_id`` is the row's identity."""
    t = lambda n: table(spark, sf_dir, n)
    rows = t("customer").select("c_custkey", "c_nationkey").join(t("part").select("p_partkey", "p_name", "p_brand"), F.col("c_custkey") == F.col("p_partkey"))
    rows = rows.join(t("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    last = F.concat(_second("p_name"), F.when(k % 10 == 3, "x").otherwise(F.replace("p_brand", F.lit("Brand#"), F.lit(""))))
    return rows.select(
        k.alias("mention_id"),
        F.concat(F.lit("M"), k.cast("string")).alias("mention_uid"),
        F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("mention_first_name"),
        F.lit("").alias("mention_middle_name"),
        F.upper(last).alias("mention_last_name"),
        F.lit("").alias("mention_suffix"),
        F.when(k % 13 != 0, F.lower("n_name")).alias("state"),
        F.concat("n_name", F.when(k % 4 == 0, " District Attorney").otherwise(" Police Department")).alias("mention_agency"),
        F.lit("").alias("mentioned_agencies"),
        F.lit("POLICE").alias("mention_agency_type"),
        (1995 + k % 7).cast("int").alias("incident_year"),
    )


def common_last_names(people: DataFrame, n: int = 5) -> DataFrame:
    """last_name: the n (a small, fixed number) last names of most persons, upper case, ties by name."""
    counts = people.groupBy(F.upper("post_last_name").alias("last_name")).agg(F.countDistinct("post_person_nbr").alias("_n"))
    return counts.orderBy(F.col("_n").desc(), "last_name").limit(n).select("last_name")


def read_mentions(spark: SparkSession, path: str, default_state: str | None = None, sample_n: int | None = None, sample_seed: int = 0) -> DataFrame:
    """Mentions of a CSV file with a header; all columns are read as text."""
    rows = spark.read.csv(path, header=True, inferSchema=False)
    return built_mentions(seeded_sample(rows, sample_n, sample_seed) if sample_n else rows, default_state)


def read_last_names(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True).select(F.upper(strip(F.col("last_name"))).alias("last_name")).distinct()


def features_file(spark: SparkSession, source: str, target: str) -> None:
    """Reads a CSV file of pairs (columns ``mention_*`` and ``post_*``, as text; a missing name is null) and
    writes it with the features beside them."""
    rows = spark.read.csv(source, header=True, inferSchema=False)
    names = [f"{s}_{p}" for s in ("mention", "post") for p in ("first_name", "middle_name", "last_name", "suffix")]
    rows = rows.withColumns({c: F.lit(None).cast("string") for c in names if c not in rows.columns})
    rows.withColumns(feature_columns()).write.mode("overwrite").csv(target, header=True)


def distinct_in_jsonl(spark: SparkSession, path: str, column: str) -> DataFrame:
    """n_rows, n_distinct of a field of JSON lines; lines without it count as rows only."""
    rows = spark.read.schema(f"`{column}` string").json(path)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.col(f"`{column}`")).alias("n_distinct"))


#: Files by bucket of a verdict, and the reasons that tell early filtering.
BUCKETS = {"auto_matched": "auto_matched", "early_filtered": "early_filtered", "review": "failed_entity_resolution"}
EARLY = ("Common last name", "Multiple persons")


def bucket(status: Column, reason: Column) -> Column:
    early = reason.contains(EARLY[0]) | reason.contains(EARLY[1])
    return F.when(status == "auto_matched", "auto_matched").when(early, "early_filtered").otherwise("review")


def input_officer() -> Column:
    c = lambda n: F.coalesce(F.col(n).cast("string"), F.lit(""))
    return F.struct(
        F.col("mention_uid").alias("officer_uid"), c("mention_first_name").alias("first_name"), c("mention_middle_name").alias("middle_name"), c("mention_last_name").alias("last_name"),
        c("mention_suffix").alias("suffix"), c("mention_agency").alias("source_agency"), F.concat(F.col("incident_year").cast("string"), F.lit("-01-01")).alias("incident_date"),
        c("state").alias("state"), c("mentioned_agencies").alias("mentioned_agencies"),
    )


def write_outputs(verdicts: DataFrame, path: str) -> dict[str, str]:
    """JSON lines by bucket and a flat CSV. ``verdicts``: mention columns, status, reason, match, candidates."""
    rows = verdicts.withColumn("_bucket", bucket(F.col("status"), F.col("reason"))).withColumn("input_officer", input_officer())
    shapes = {
        "auto_matched": F.struct("input_officer", F.col("match").alias("post_match")),
        "early_filtered": F.struct("input_officer", F.col("reason").alias("review_reason")),
        "review": F.struct("input_officer", F.col("reason").alias("review_reason"), "candidates"),
    }
    paths = {BUCKETS[b]: f"{path}/{BUCKETS[b]}.jsonl" for b in BUCKETS} | {"csv": f"{path}/results.csv"}
    for b, shape in shapes.items():
        rows.where(F.col("_bucket") == b).select(F.to_json(shape).alias("value")).write.mode("overwrite").text(paths[BUCKETS[b]])
    flat = rows.select("input_officer.*", F.col("_bucket").alias("status"), F.when(F.col("_bucket") == "auto_matched", F.col("match.post_person_nbr")).otherwise("").alias("post_person_nbr"),
                       F.when(F.col("_bucket") == "auto_matched", "").otherwise(F.col("reason")).alias("review_reason"))
    flat.write.mode("overwrite").csv(paths["csv"], header=True)
    return paths
