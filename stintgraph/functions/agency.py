"""Agencies: what kind a name tells, which are to be compared, and the guard before validation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stintgraph.functions.names import strip

#: Words of agencies that aren't law enforcement (the name is padded with blanks), and of those that are.
NON_LE = ("district attorney", "attorney general", "public defender", "coroner", "medical examiner", " da ", " me ", "office of the da")
LE = ("police", "sheriff", "marshal", "patrol", "highway patrol", "probation", "corrections", "department of public safety", "public safety")
GUARD_REASON = "Source agency is non-LE (DA/Coroner/ME/etc.) with no mentioned LE agencies; cannot auto-validate against an LE POST agency"
EMPTY_POST, NOTHING_TO_COMPARE, NOT_VALIDATED = "POST agency is empty", "No agencies to compare against", "Agency cannot be validated"


def _any(c: Column, words: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, (c.contains(w) for w in words))


def is_non_le(name: Column) -> Column:
    """False for null and empty names, and for names with any word of law enforcement."""
    padded = F.concat(F.lit(" "), strip(F.lower(name)), F.lit(" "))
    return F.coalesce(~_any(padded, LE) & _any(padded, NON_LE), F.lit(False))


def is_le(name: Column) -> Column:
    return F.coalesce(_any(F.lower(name), LE), F.lit(False))


#: A value of a list as text: quoted, or a bare word or number.
_ITEM = r"""'(?:[^'\\\n]|\\.)*'|"(?:[^"\\\n]|\\.)*"|None|True|False|-?\d+(?:\.\d*)?"""
_LIST = rf"^\s*\[\s*(?:(?:{_ITEM})\s*(?:,\s*(?:{_ITEM})\s*)*,?\s*)?\]\s*$"


def _item(x: Column) -> Column:
    """The text of an item; null for those that count as nothing."""
    quoted = x.startswith("'") | x.startswith('"')
    inner = F.regexp_replace(F.substring(x, 2, F.length(x) - 2), r"\\(['\"\\])", "$1")
    return F.when(quoted, inner).when(~x.isin("None", "False") & ~x.rlike(r"^-?0+(\.0*)?$"), x)


def to_check(agency: Column, mentioned: Column) -> Column:
    """The source agency and the mentioned ones: a list as text is taken apart (a comma may end it, words
    within quotes stay as they are), any other text is one agency; blank text and null or empty entries
    are left out."""
    text = F.when(strip(mentioned) != "", mentioned)
    listed = F.transform(F.regexp_extract_all(text, F.lit(_ITEM), F.lit(0)), _item)
    named = F.when(text.rlike(_LIST), listed).when(text.isNotNull(), F.array(text))
    every = F.concat(F.array(agency), F.coalesce(named, F.array().cast("array<string>")))
    return F.filter(every, lambda x: x.isNotNull() & (x != ""))


def all_non_le(agencies: Column) -> Column:
    return (F.size(agencies) > 0) & F.forall(agencies, is_non_le)


def guarded(agencies: Column, post: Column) -> Column:
    """True where every agency is known not to be law enforcement and the employer is."""
    return all_non_le(agencies) & is_le(post)


def answer_matches(answer: Column) -> Column:
    """The rule for a validator's answer in words."""
    a = F.upper(strip(answer))
    return a.contains("MATCH") & ~a.contains("NO_MATCH")


PROMPT = "Do the employer and any of the agencies name the very same organisation?\n\nEmployer: %s\n\nAgencies:\n%s\n\nAnswer MATCH or NO_MATCH only."


def prompt(agencies: Column, post: Column) -> Column:
    listed = F.array_join(F.transform(agencies, lambda x: F.concat(F.lit("- "), x)), "\n")
    return F.format_string(PROMPT, post, listed)


def accept_all(agencies: Column, post: Column) -> Column:
    """The default validator: what the guard lets pass is valid."""
    return F.lit("MATCH")


def validation(agency: Column, mentioned: Column, post: Column, validator: Callable[[Column, Column], Column] = accept_all) -> Column:
    """struct valid, reason. ``validator`` gives an answer in words; it is asked only where the rules before it don't decide."""
    agencies = to_check(agency, mentioned)
    reason = (
        F.when(F.coalesce(post, F.lit("")) == "", EMPTY_POST)
        .when(F.size(agencies) == 0, NOTHING_TO_COMPARE)
        .when(guarded(agencies, post), GUARD_REASON)
        .when(answer_matches(validator(agencies, post)), "")
        .otherwise(NOT_VALIDATED)
    )
    return F.struct((reason == "").alias("valid"), reason.alias("reason"))
