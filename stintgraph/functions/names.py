"""Names and states: normal forms and similarity features, as columns."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Two-letter codes and the states as the employment table stores them.
STATES = {
    "AL": "alabama", "AK": "alaska", "AZ": "arizona", "AR": "arkansas", "CA": "california", "CO": "colorado",
    "CT": "connecticut", "DE": "delaware", "DC": "columbia", "FL": "florida", "GA": "georgia", "HI": "hawaii",
    "ID": "idaho", "IL": "illinois", "IN": "indiana", "IA": "iowa", "KS": "kansas", "KY": "kentucky",
    "LA": "louisiana", "ME": "maine", "MD": "maryland", "MA": "massachusetts", "MI": "michigan", "MN": "minnesota",
    "MS": "mississippi", "MO": "missouri", "MT": "montana", "NE": "nebraska", "NV": "nevada", "NH": "new-hampshire",
    "NJ": "new-jersey", "NM": "new-mexico", "NY": "new-york", "NC": "north-carolina", "ND": "north-dakota",
    "OH": "ohio", "OK": "oklahoma", "OR": "oregon", "PA": "pennsylvania", "RI": "rhode-island",
    "SC": "south-carolina", "SD": "south-dakota", "TN": "tennessee", "TX": "texas", "UT": "utah", "VT": "vermont",
    "VA": "virginia", "WA": "washington", "WV": "west-virginia", "WI": "wisconsin", "WY": "wyoming",
}

#: Jaro similarity above which equal beginnings of up to four characters raise it.
BOOSTED_ABOVE = 0.7


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normal_state(c: Column) -> Column:
    """A code of two letters becomes the stored state, anything else its lower case; empty becomes null."""
    s = strip(c)
    of = F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv])
    return F.when(c.isNull() | (c == ""), None).otherwise(F.coalesce(F.element_at(of, F.upper(s)), F.lower(s)))


def normal_state_of(s: str | None) -> str | None:
    """The same for a parameter."""
    return STATES.get(s.strip().upper(), s.strip().lower()) if s else None


def _jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    taken = [False] * len(b)
    mine = []
    for i, x in enumerate(a):
        for k in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[k] and b[k] == x:
                taken[k] = True
                mine.append(x)
                break
    if not mine:
        return 0.0
    theirs = [y for y, t in zip(b, taken, strict=True) if t]
    m, moved = len(mine), sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    if jaro <= BOOSTED_ABOVE:
        return jaro
    same = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(len(a), len(b), 4))
    return jaro + 0.1 * same * (1 - jaro)


@F.pandas_udf(DoubleType())
def _jaro_winkler_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple, float | None] = {}
    out = []
    for pair in zip(a, b, strict=True):
        if pair not in known:
            known[pair] = None if pair[0] is None or pair[1] is None else _jaro_winkler(*pair)
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def jaro_winkler(a: Column, b: Column) -> Column:
    """Equal names, most of what candidates hold, never reach Python's kernel."""
    return F.when(a == b, F.when(a == "", 0.0).otherwise(1.0)).otherwise(_jaro_winkler_udf(F.when(a != b, a), F.when(a != b, b)))


def levenshtein_norm(a: Column, b: Column) -> Column:
    """1 less the distance over the longer length: 1 is the same."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b))


def _guarded(a: Column, b: Column, kernel: Callable[[Column, Column], Column], null: float, empty: float) -> Column:
    x, y = F.lower(a), F.lower(b)
    return F.when(a.isNull() | b.isNull(), F.lit(null)).when((x == "") & (y == ""), F.lit(empty)).otherwise(kernel(x, y))


def string_features(a: Column, b: Column) -> dict[str, Column]:
    """jaro, levenshtein and length_ratio of lower-cased names. Null counts as 0, 1, 0; two empty names as 0, 1, 1."""
    return {
        "jaro": _guarded(a, b, jaro_winkler, 0.0, 0.0),
        "levenshtein": _guarded(a, b, levenshtein_norm, 1.0, 1.0),
        "length_ratio": _guarded(a, b, length_ratio, 0.0, 1.0),
    }


def full_name(prefix: str) -> Column:
    """Parts that aren't null joined by blanks; empty parts stay, as two blanks."""
    return F.concat_ws(" ", *(F.col(f"{prefix}_{p}") for p in ("first_name", "middle_name", "last_name", "suffix")))


def cosine(a: Column, b: Column) -> Column:
    """0 where lengths differ or a norm is 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) != F.size(b)) | (norms == 0), 0.0).otherwise(dot(a, b) / norms)


def hashed_ngrams(text: Column, n: int = 3, buckets: int = 64) -> Column:
    """The default embedder: counts of hashed character n-grams of the lower-cased text."""
    marked = F.concat(F.lit("^"), F.lower(text), F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1))), lambda i: F.pmod(F.xxhash64(F.substring(marked, i, n)), F.lit(buckets)))
    return F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda k: F.size(F.filter(grams, lambda g: g == k)).cast("double"))


PARTS = ("first", "middle", "last", "suffix", "full")


def feature_columns(embed: Callable[[Column], Column] = hashed_ngrams) -> dict[str, Column]:
    """The 20 features ``{part}_name_{feature}`` and both full names, from columns ``mention_*`` and
    ``post_*``. All middle-name features are 0.5 where either middle name is null."""
    out: dict[str, Column] = {"mention_full_name": full_name("mention"), "post_full_name": full_name("post")}
    for part in PARTS:
        name = {"full": "full_name", "suffix": "suffix"}.get(part, f"{part}_name")
        a, b = (out[f"{s}_full_name"] if part == "full" else F.col(f"{s}_{name}") for s in ("mention", "post"))
        own = string_features(a, b)
        own["embedding"] = F.when(a.isNull() | b.isNull(), 0.0).otherwise(cosine(embed(a), embed(b)))
        for k, c in own.items():
            out[f"{part}_name_{k}"] = F.when(a.isNull() | b.isNull(), 0.5).otherwise(c) if part == "middle" else c
    return out
