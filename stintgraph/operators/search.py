"""The query surface: search, counts, officers by name, name uniqueness, candidate nets.

Names of joins are taken literally; only the search parameters keep LIKE's wildcards. Pages have a
total order.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintgraph.functions.names import normal_state_of

#: How many rows an offset without a limit gives.
OPEN_PAGE = 1000
#: Rows that a search for people to look at gives, unless asked for others.
SHOWN = 25
#: Shares of the records that a mention without names and state meets.
SALTS = 64


@dataclass(frozen=True)
class Search:
    """Parameters that are empty or None don't filter."""

    first_name: str | None = None
    last_name: str | None = None
    agency: str | None = None
    state: str | None = None
    limit: int | None = None
    offset: int | None = None

    def condition(self) -> Column:
        parts = [F.col(c).ilike(f"%{x}%") for c, x in (("post_first_name", self.first_name), ("post_last_name", self.last_name), ("post_agency_name", self.agency)) if x]
        if self.state:
            parts.append(F.col("state") == normal_state_of(self.state))
        return reduce(Column.__and__, parts, F.lit(True))


def search(employment: DataFrame, q: Search, order: str = "rec_ord") -> DataFrame:
    found = employment.where(q.condition())
    if not q.limit and not q.offset:
        return found
    return found.orderBy(order).offset(q.offset or 0).limit(q.limit or OPEN_PAGE)


def count(employment: DataFrame, q: Search) -> DataFrame:
    return employment.where(q.condition()).agg(F.count(F.lit(1)).alias("n"))


def search_summary(employment: DataFrame, q: Search) -> DataFrame:
    """Rows and distinct persons of a search that names a person or an agency."""
    if not (q.first_name or q.last_name or q.agency):
        raise ValueError("a name or an agency is needed")
    return search(employment, q).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("post_person_nbr").alias("n_persons"))


def shown(employment: DataFrame, q: Search) -> DataFrame:
    """The first SHOWN rows (or ``limit``) of a search that names a person or an agency."""
    if not (q.first_name or q.last_name or q.agency):
        raise ValueError("a name or an agency is needed")
    return search(employment, replace(q, limit=q.limit or SHOWN))


def count_by_state(employment: DataFrame) -> DataFrame:
    return employment.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def _keyed(mentions: DataFrame) -> DataFrame:
    first, last = (F.coalesce(F.lower(c), F.lit("")) for c in ("mention_first_name", "mention_last_name"))
    return mentions.withColumns({"m_fn": first, "m_ln": last, "m_fn2": F.substring(first, 1, 2), "m_ln2": F.substring(last, 1, 2)})


def officers_by_name(mentions: DataFrame, employment: DataFrame, scoped: bool = True) -> DataFrame:
    """Records of the same first name whose last name begins with the mention's, in its state (in all
    of them where it has none, or unless ``scoped``). Blank names find nothing."""
    m = _keyed(mentions.withColumnRenamed("state", "m_state")).where("m_fn <> '' and m_ln <> ''")
    e = employment
    fits = (e.fn_lc == m.m_fn) & e.ln_lc.startswith(m.m_ln)
    if not scoped:
        return m.join(e, fits)
    # two equi-joins: a state that may be missing would hide the key of one
    inside = m.where("m_state is not null").join(e, fits & (e.state == m.m_state))
    return inside.unionByName(m.where("m_state is null").join(e, fits))


def same_name_count(mentions: DataFrame, employment: DataFrame) -> DataFrame:
    """mention_id, n: distinct persons by ``officers_by_name``, zeros kept; records without a person count as one.
    Mentions of the same names and state meet each person of a name once, not its records."""
    key = F.struct("mention_first_name", "mention_last_name", "state")
    asked = mentions.select("mention_first_name", "mention_last_name", "state").distinct().withColumn("mention_id", key)
    people = employment.select("fn_lc", "ln_lc", "state", F.coalesce("post_person_nbr", F.lit("")).alias("post_person_nbr")).distinct()
    found = officers_by_name(asked, people).groupBy(F.col("mention_id").alias("_key")).agg(F.countDistinct("post_person_nbr").alias("n"))
    return mentions.withColumn("_key", key).join(found, "_key", "left").select("mention_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def name_uniqueness(names: DataFrame, employment: DataFrame) -> DataFrame:
    """first_name, last_name, n: distinct persons of exactly these names, whatever their case, in all states."""
    asked = names.select("first_name", "last_name").distinct()
    e = employment.select("fn_lc", "ln_lc", "post_person_nbr")
    met = asked.join(e, (F.lower("first_name") == e.fn_lc) & (F.lower("last_name") == e.ln_lc), "left")
    none = F.max(F.when(F.col("fn_lc").isNotNull() & F.col("post_person_nbr").isNull(), 1).otherwise(0))
    return met.groupBy("first_name", "last_name").agg((F.countDistinct("post_person_nbr") + none).cast("bigint").alias("n"))


def candidate_nets(mentions: DataFrame, employment: DataFrame) -> DataFrame:
    """Both nets, one row per mention, record and net (1 or 2): the first two letters of the first name
    and the whole last name; or the whole first name and two letters of the last. Within the state,
    where the mention has one. A name of fewer than two letters asks for no prefix, a blank one for
    nothing at all. Each net is equi-joins of its own: as one condition they would be compared row by row."""
    m, e = _keyed(mentions.withColumnRenamed("state", "m_state")), employment
    f, last = F.length("m_fn"), F.length("m_ln")
    here = e.state == m.m_state
    anywhere = m.m_state.isNull() | here
    salt = e.withColumn("_salt", F.pmod(F.xxhash64("rec_ord"), F.lit(SALTS)).cast("int"))
    nets = []
    for net, asks, prefix, named, whole in ((1, f > 1, e.fn2 == m.m_fn2, last > 0, e.ln_lc == m.m_ln), (2, last > 1, e.ln2 == m.m_ln2, f > 0, e.fn_lc == m.m_fn)):
        usual, rest = m.where(asks & named), m.where(~asks & ~named)
        parts = [
            usual.where("m_state is not null").join(e, prefix & whole & here),
            usual.where("m_state is null").join(e, prefix & whole),
            m.where(~asks & named).join(e, whole & anywhere),
            m.where(asks & ~named).join(e, prefix & anywhere),
            rest.where("m_state is not null").join(e, here),
            # neither names nor a state: every record, by dealt shares of them
            rest.where("m_state is null").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).join(salt, "_salt").drop("_salt"),
        ]
        nets += [x.withColumn("net", F.lit(net)) for x in parts]
    return reduce(DataFrame.unionByName, nets)


RECORD = ("post_person_nbr", "post_start_date", "post_end_date", "post_agency_name", "state")


def candidate_net(mentions: DataFrame, employment: DataFrame) -> DataFrame:
    """Union of both nets; of records that agree in RECORD the first stays, net 1 before net 2, then by primary key."""
    first = Window.partitionBy("mention_id", *RECORD).orderBy("net", "rec_ord")
    return candidate_nets(mentions, employment).withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def net_summary(mentions: DataFrame, net: DataFrame) -> DataFrame:
    n = net.groupBy("mention_id").agg(F.count(F.lit(1)).alias("n"))
    every = mentions.select("mention_id").join(n, "mention_id", "left")
    return every.agg(F.count(F.lit(1)).alias("total_mentions"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_candidates"), F.count_if(F.col("n") > 0).alias("mentions_with_candidates"))


def agency_counties(agencies: DataFrame, counties: DataFrame | None = None) -> DataFrame:
    """agency, county: null without a table of counties, and for agencies not in it."""
    if counties is None:
        return agencies.withColumn("county", F.lit(None).cast("string"))
    return agencies.join(counties, "agency", "left")
