"""URL filters: logistic regression on hashed character n-grams, behind a table of host rules.

The model is fitted on the driver from a labelled table of at most ``MAX_LABELLED`` rows; its weights
are whole numbers, so that scoring is exact integer arithmetic in any engine. Scoring and rules are
built-in expressions of one projection.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Features are this many buckets; n-grams have GRAM characters; weights are in thousandths.
BUCKETS, GRAM, UNIT = 16_384, 3, 1000
#: The labelled table may have so many rows: it is fitted on the driver.
MAX_LABELLED = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    HostRule("block", "com", "/en/"),
    HostRule("allow", "example.com", "/en/7"),
    HostRule("allow", "net", "/de/"),
    HostRule("block", "example.net", "/de/8"),
    HostRule("block", "org", "/es/"),
)

#: Words of host names: of unwanted kinds (gambling, pills, advertising, adult, junk) and of wanted ones.
UNWANTED = (
    "casino poker roulette jackpot slots betting bets lottery bingo wager pills viagra pharma meds steroids slimming cheap discount replica "
    "payday loans spam spammy linkfarm clickbait popups adserver adverts ads banner tracker tracking adult porn xxx escorts hookup webcams "
    "freebies free winner prizes bonus giveaway"
).split()
WANTED = (
    "library museum garden weather history physics university school travel recipes music science city books journal news health village "
    "archive forum sports nature maths cooking river mountain theatre cinema gazette herald observer station nation language writing "
    "astronomy railway painting parish orchestra"
).split()
ENDINGS, BEFORE = ("com", "net", "org", "info", "example.com", "example.net", "example.org"), ("", "www.", "m.", "blog.")
#: Paths that go with a label, and paths that go with both.
PATHS = (
    ("/articles/2021/spring.html", "/docs/guide", "/wiki/Main_Page", "/about/people", "/catalogue/item/42", "/"),
    ("/bonus/claim-now", "/order/cheap-deal.html", "/click/out/88", "/promo/free-trial", "/signup/win", "/go/offer7"),
)
EITHER = ("", "/index.html", "/en/17", "/de/430.html", "/fr/82/", "/es/961", "/page/3", "/p?id=5")


#: Wanted as well: so many names of invented syllables, as most hosts have none of the words.
INVENTED, ONSETS, VOWELS, CODAS = 240, "b c d f g h j k l m n p r s t v w z st tr".split(), "a e i o u".split(), ["", "n", "r", "s", "l"]


def labelled_urls() -> list[tuple[str, int]]:
    """The labelled table, 1 for unwanted: every word with the ones four and thirteen places on, joined by a hyphen or
    by nothing, with a number, and alone; each host with a path of its label and with two that say nothing."""
    rows = []
    syllables = [a + b + c for a in ONSETS for b in VOWELS for c in CODAS]
    for i in range(INVENTED):
        name = "".join(syllables[(i * k + k) % len(syllables)] for k in (37, 101, 263)[: 2 + i % 2])
        rows += [(f"http://{BEFORE[i % len(BEFORE)]}{name}.{ENDINGS[i % len(ENDINGS)]}{EITHER[(i * k) % len(EITHER)]}", 0) for k in (1, 3)]
    for y, words in enumerate((WANTED, UNWANTED)):
        for i, w in enumerate(words):
            near, far = (words[(i + k) % len(words)] for k in (4, 13))
            for k, name in enumerate((f"{w}-{near}", f"{far}{w}", f"{w}-{far}", f"{w}{2 * i + 1}", w)):
                host = f"{BEFORE[(i + k) % len(BEFORE)]}{name}.{ENDINGS[(2 * i + 3 * k) % len(ENDINGS)]}"
                rows += [(f"http://{host}{p}", y) for p in (PATHS[y][(i + k) % len(PATHS[y])], EITHER[(i + 3 * k) % len(EITHER)], EITHER[(3 * i + k + 1) % len(EITHER)])]
    return rows


LABELLED = tuple(labelled_urls())


@dataclass(frozen=True)
class UrlModel:
    """Whole weights by bucket, and a bias: a URL is blocked if their sum is above 0."""

    weights: tuple[int, ...]
    bias: int


def host_path(url: str | None) -> tuple[str, str]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path:
    from there up to ``?``, ``#`` or the end. Both empty for null or without ``://``."""
    m = re.search("://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(str.maketrans(UPPER, LOWER)), m[2]) if m else ("", "")


def buckets(url: str | None) -> list[int]:
    """Distinct buckets of the n-grams of the host and of the path, each between its own marks."""
    host, path = host_path(url)
    whole = [f"h{x}" for x in _grams(f"^{host}$")] + [f"p{x}" for x in _grams(f"^{path}$")]
    return sorted({int(hashlib.md5(x.encode()).hexdigest()[:4], 16) % BUCKETS for x in whole})


def _grams(s: str) -> list[str]:
    return [s[i : i + GRAM] for i in range(len(s) - GRAM + 1)]


def fit(labelled: list[tuple[str | None, int]], rounds: int = 600, rate: float = 2.0, penalty: float = 1e-4) -> UrlModel:
    """Logistic regression by full gradient steps. Without rows of both labels nothing is blocked."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"the labelled table has over {MAX_LABELLED} rows")
    rows = [(buckets(u), y) for u, y in labelled if y is not None]
    if len({y for _, y in rows}) < 2:
        return UrlModel((0,) * BUCKETS, -1)
    at = np.repeat(np.arange(len(rows)), [len(x) for x, _ in rows])
    col = np.concatenate([x for x, _ in rows]).astype(int)
    y, w, b = np.array([y for _, y in rows], float), np.zeros(BUCKETS), 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(np.bincount(at, w[col], len(rows)) + b)))
        err = (p - y) / len(rows)
        w -= rate * (np.bincount(col, err[at], BUCKETS) + penalty * w)
        b -= rate * err.sum()
    return UrlModel(tuple(int(x) for x in np.round(w * UNIT)), math.floor(b * UNIT))


def _feature_buckets(marked: Column, kind: str) -> Column:
    """Of a string of two characters at least. Characters are taken apart once: linear in length."""
    chars = F.split(marked, "")
    return F.transform(
        F.sequence(F.lit(0), F.length(marked) - GRAM),
        lambda i: (F.conv(F.substring(F.md5(F.concat(F.lit(kind), *(F.get(chars, i + k) for k in range(GRAM)))), 1, 4), 16, 10).cast("int") % BUCKETS),
    )


def judge(pages: DataFrame, model: UrlModel, url: str = "url", rules: tuple[HostRule, ...] = RULES) -> DataFrame:
    """The columns of ``pages`` and the struct ``_url``: host, path, rule (the longest that fits, or
    null), score (long), verdict (``allow`` or ``block``). Longest is by the rule's string; of two
    equally long the first in the table wins. One row per row; a null URL has an empty host and path
    and is judged by the model like any other; other columns pass through."""
    has = F.coalesce(F.col(f"_row.`{url}`"), F.lit(""))
    rows = pages.select(F.struct("*").alias("_row")).withColumns({
        "host": F.translate(F.regexp_extract(has, "://([^/?#]*)", 1), UPPER, LOWER),
        "path": F.regexp_extract(has, "://[^/?#]*([^?#]*)", 1),
    })
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col("path").startswith(r.path)
        rule, verdict = F.when(fits, r.name).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    marked = [(F.concat(F.lit("^"), F.col(c), F.lit("$")), c[0]) for c in ("host", "path")]
    grams = [F.when(F.length(m) >= GRAM, _feature_buckets(m, k)).otherwise(F.array().cast("array<int>")) for m, k in marked]
    weights = F.split(F.lit(",".join(map(str, model.weights))), ",").cast("array<int>")
    score = F.aggregate(F.array_distinct(F.concat(*grams)), F.lit(model.bias).cast("bigint"), lambda a, x: a + F.get(weights, x))
    scored = rows.withColumn("score", score).withColumns({"rule": rule, "_by_rule": verdict})
    out = F.struct("host", "path", "rule", "score", F.coalesce("_by_rule", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"))
    return scored.select("_row.*", out.alias("_url"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, fit(list(LABELLED))).selectExpr("page_id", *(f"_url.{x}" for x in ("host", "path", "rule", "verdict", "score")))


def _sql() -> str:
    m = fit(list(LABELLED))
    case = "\n".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {{{r.name!r}}}" for r in sorted(RULES, key=lambda r: -len(r.name)))
    name, verdict = case, case
    for r in RULES:
        name, verdict = name.replace(f"{{{r.name!r}}}", f"'{r.name}'"), verdict.replace(f"{{{r.name!r}}}", f"'{r.verdict}'")
    grams = lambda c: f"list_transform(range(1, CAST(length({c}) + 1 AS BIGINT)), lambda i: '{c[0]}' || substr('^' || {c} || '$', i, {GRAM}))"
    return f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
w AS (SELECT unnest(range(0, {BUCKETS})) AS b, unnest([{", ".join(map(str, m.weights))}]) AS weight),
g AS (SELECT DISTINCT page_id, CAST('0x' || substr(md5(x), 1, 4) AS BIGINT) % {BUCKETS} AS b
    FROM (SELECT page_id, unnest(list_concat({grams("host")}, {grams("path")})) AS x FROM u)),
s AS (SELECT page_id, CAST(sum(weight) + ({m.bias}) AS BIGINT) AS total FROM g JOIN w USING (b) GROUP BY page_id)
SELECT page_id, host, path, CASE {name} END AS rule, coalesce(total, {m.bias}) AS score,
  coalesce(CASE {verdict} END, CASE WHEN coalesce(total, {m.bias}) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN s USING (page_id)"""


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLE_SQL = {"op1_url_filter": _sql()}
