"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every measure is an integer computed inside the row that holds the text, so a rule set costs one
scan: no shuffle, no user function, whatever the number of rules.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that parts words, and the characters that count as symbols.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: Frequent function words of the corpus' languages, lower case.
STOP_WORDS = (
    "the of and to in is that was it for on be with as are by this at or an "
    "la le de des du et les un une que qui pour par pas en elle "
    "el los las y del se con por para su es "
    "der die und das nicht zu ist den von mit im ein eine auf"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` must be at least ``low`` and at most ``high`` per hundred of ``per`` (or in
    absolute numbers, where ``per`` is empty). A missing bound doesn't bind."""

    name: str
    measure: str
    per: str = ""
    low: int | None = None
    high: int | None = None


#: What every kept document satisfies, in integers: shares are per hundred.
BASE_RULES = (
    Rule("enough words", "n_words", low=50),
    Rule("few repeated word windows", "n_repeat_words", "n_words", high=50),
)

#: The method's own thresholds.
RULES = (
    Rule("word length", "word_chars", "n_words", low=250, high=1200),
    Rule("few symbols", "n_symbols", "n_words", high=10),
    Rule("some stop words", "n_stop_words", low=2),
    Rule("share of stop words", "n_stop_words", "n_words", low=2),
    # by characters, not by lines: a header that is also the footer is much of few lines, but little of a text
    Rule("few repeated lines", "dup_line_chars", "line_chars", high=30),
)

#: The rules of op10 and its SQL twin, which count repeated lines.
SQL_RULES = (*RULES[:-1], Rule("few repeated lines", "n_dup_lines", "n_lines", high=30))


def _broken(rule: Rule) -> Column:
    """True where the rule is broken; never null, as no measure is."""
    value, per = F.col(rule.measure), F.col(rule.per) if rule.per else None
    value = value * 100 if rule.per else value
    bound = lambda x: F.lit(x) * per if rule.per else F.lit(x)
    parts = [value < bound(rule.low)] if rule.low is not None else []
    parts += [value > bound(rule.high)] if rule.high is not None else []
    return reduce(Column.__or__, parts, F.lit(False))


def any_broken(rules: tuple[Rule, ...]) -> Column:
    return reduce(Column.__or__, map(_broken, rules), F.lit(False))


def measure(docs: DataFrame, text: str = "text", prefix: str = "_q") -> DataFrame:
    """``docs`` with one column more, the struct ``{prefix}``: n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, line_chars, dup_line_chars, n_stop_words, n_repeat_words (all long).

    Lines are parted by ``\\n`` and count if they hold a word. A word repeats if it lies in a window
    of three words that the text holds twice or more. A null text counts as an empty one: every
    measure is 0. Windows are compared by their 64-bit hashes within one text.
    """
    w, g, s, p = (f"{prefix}_{x}" for x in ("words", "grams", "sorted", "places"))
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(whole, F.lit(SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    grams = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    ordered = F.when(
        F.size(F.array_distinct(g)) < F.size(g),
        F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    places = F.array_sort(F.transform(
        F.filter(s, lambda x, k: (x.h == F.get(s, k - 1).h) | (x.h == F.get(s, k + 1).h)),
        lambda x: x.i,
    ))
    covered = F.aggregate(
        p,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a.n + i + 3 - F.greatest(i, a.end)).alias("n"), (i + 3).alias("end")),
        lambda a: a.n,
    )
    n = lambda c, name: c.cast("bigint").alias(name)
    return (
        docs.withColumns({w: words, f"{prefix}_lines": lines})
        .withColumn(g, grams)
        .withColumn(s, ordered)
        .withColumn(p, places)
        .withColumn(
            prefix,
            F.struct(
                n(F.size(w), "n_words"),
                n(F.length(F.array_join(w, "")), "word_chars"),
                n(F.length(whole) - F.length(F.translate(whole, SYMBOLS, "")), "n_symbols"),
                n(F.size(f"{prefix}_lines"), "n_lines"),
                n(F.size(f"{prefix}_lines") - F.size(F.array_distinct(f"{prefix}_lines")), "n_dup_lines"),
                n(F.length(F.array_join(f"{prefix}_lines", "")), "line_chars"),
                n(F.length(F.array_join(f"{prefix}_lines", "")) - F.length(F.array_join(F.array_distinct(f"{prefix}_lines"), "")), "dup_line_chars"),
                n(F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))), "n_stop_words"),
                n(F.coalesce(covered, F.lit(0)), "n_repeat_words"),
            ),
        )
        .drop(w, g, s, p, f"{prefix}_lines")
    )


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The columns of ``docs`` and ``_quality``: a struct of MEASURES, ``base_failed`` and
    ``kept`` (false if a base rule or one of ``rules`` is broken). One row for each row of ``docs``:
    repeated rows and ids stay apart, other columns pass through. Null and empty texts hold no word,
    so they fail. Columns named ``_q...`` or ``_quality`` must not be in ``docs``."""
    flat = [F.col(f"_q.{x}").alias(x) for x in (*MEASURES, *INNER)]
    measured = measure(docs.select(F.struct("*").alias("_row")).withColumn("_text", F.col(f"_row.`{text}`")), "_text")
    judged = measured.select("_row", *flat).withColumns({"base_failed": any_broken(BASE_RULES), "_method": any_broken(rules)})
    verdict = F.struct(*MEASURES, "base_failed", (~F.col("base_failed") & ~F.col("_method")).alias("kept"))
    # one verdict a row, through a generator: no filter on it moves below, where it would stand over copies of every measure
    return judged.select("_row", F.explode_outer(F.array(verdict)).alias("_quality")).select("_row.*", "_quality")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words")
#: Measures that rules read and verdicts don't show.
INNER = ("line_chars", "dup_line_chars")


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with the columns of ``docs``."""
    return judge(docs, text, rules).where("_quality.kept").select(*[f"`{c}`" for c in docs.columns])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By SQL_RULES, as its SQL has it; the operator's own rules are those of ``quality_verdicts`` and the pipeline."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs, rules=SQL_RULES).selectExpr("doc_id", *(f"_quality.{x}" for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts by RULES, for SQL of the rules as they are now."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).selectExpr("doc_id", "_quality.kept")


def _sql_bounds(rules: tuple[Rule, ...]) -> str:
    def one(r: Rule) -> list[str]:
        value, per = (f"100 * {r.measure}", f" * {r.per}") if r.per else (r.measure, "")
        return [f"{value} {sign} {x}{per}" for sign, x in (("<", r.low), (">", r.high)) if x is not None]

    return " OR ".join(x for r in rules for x in one(r))


MEASURED_SQL = rf"""
SELECT doc_id, text, lang, source, n_chars, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  CAST(len(list_filter(w, lambda x: lower(x) IN ({", ".join(repr(x) for x in STOP_WORDS)}))) AS BIGINT) AS n_stop_words,
  CAST(coalesce(n_rep, 0) AS BIGINT) AS n_repeat_words
FROM (SELECT *, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents)
LEFT JOIN (
  SELECT doc_id AS rep_id, count(DISTINCT p) AS n_rep FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (
        SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (
          SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i
          FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents))))
    WHERE n >= 2) GROUP BY doc_id) ON doc_id = rep_id"""

#: With the measures of repeated lines by their characters.
_BY_CHARACTERS = MEASURED_SQL.replace(
    "CAST(len(l) AS BIGINT) AS n_lines,",
    "CAST(len(l) AS BIGINT) AS n_lines, length(array_to_string(l, '')) AS line_chars, length(array_to_string(l, '')) - length(array_to_string(list_distinct(l), '')) AS dup_line_chars,",
)
QUERIES = {"op10_quality_rules": op10_quality_rules, "quality_verdicts": quality_verdicts}
ORACLE_SQL = {
    "quality_verdicts": f"SELECT doc_id, NOT ({_sql_bounds(BASE_RULES)}) AND NOT ({_sql_bounds(RULES)}) AS kept FROM ({_BY_CHARACTERS})",
    "op10_quality_rules": f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({_sql_bounds(BASE_RULES)}) AS base_failed,
  NOT ({_sql_bounds(BASE_RULES)}) AND NOT ({_sql_bounds(SQL_RULES)}) AS kept
FROM ({MEASURED_SQL})"""
}
