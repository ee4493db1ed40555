"""License scans: one Aho-Corasick automaton finds notice phrases and identifier tags; a
shunting-yard parser evaluates the licence expression behind each tag."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintgraph.llm.shared import batch, portions

#: Phrases whose words, standing consecutively, are a base hit, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notice phrases, in words as the scan sees them.
NOTICES = {
    "isc license": "isc",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "boost software license": "bsl",
    "creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
#: Families of identifiers by their first letters, longest first, and how freely each may be reused.
FAMILIES = {
    "public-domain": 1.0, "unlicense": 1.0, "cc-by-nc": 0.2, "cc-by-nd": 0.2, "cc-by-sa": 0.5, "apache": 1.0, "cc-by": 0.9, "lgpl": 0.5, "agpl": 0.1,
    "cc0": 1.0, "mit": 1.0, "bsd": 1.0, "isc": 1.0, "bsl": 1.0, "mpl": 0.5, "epl": 0.5, "gpl": 0.3, "all-rights-reserved": 0.0,
}
#: Of an identifier of no known family.
UNKNOWN = 0.2
#: A licence with an exception is at least this free.
EXCEPTED = 0.5

BINDS = {"or": 1, "and": 2, "with": 3}
#: Bytes that part words become blanks; A-Z become a-z.
_FOLD = bytes(x + 32 if 65 <= x <= 90 else x if 48 <= x <= 57 or 97 <= x <= 122 or x >= 128 else 32 for x in range(256))
#: What stands behind a tag: an expression, up to what can't be of it.
_EXPRESSION = re.compile(rb"[ \t]*:[ \t]*([A-Za-z0-9.+() \t-]+)")
_WORD = re.compile(rb"[^ \t\n\x0b\f\r]+")
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting yard: the longest prefix of ``tokens`` that can be an expression, in postfix order; None if none is."""
    out: list[str] = []
    stack: list[str] = []
    operand_due, depth, best = True, 0, None
    for t in tokens:
        if t == "(":
            if not operand_due:
                break
            stack.append(t)
            depth += 1
            continue
        if t == ")":
            if operand_due or not depth:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif t in BINDS:
            if operand_due:
                break
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[t]:
                out.append(stack.pop())
            stack.append(t)
            operand_due = True
            continue
        elif operand_due:
            out.append(t)
            operand_due = False
        else:
            break
        if not depth:
            best = out + stack[::-1]
    return best


def family(identifier: str) -> str:
    return next((f for f in sorted(FAMILIES, key=len, reverse=True) if identifier.startswith(f)), identifier)


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """Labels of an expression and how freely it allows reuse: ``and`` takes the stricter side, ``or``
    the freer, ``with`` softens its licence. None if it isn't an expression."""
    order = postfix(_TOKEN.findall(expression.lower()))
    if order is None:
        return None
    stack: list[tuple[set[str], float]] = []
    for t in order:
        if t not in BINDS:
            stack.append(({family(t)}, FAMILIES.get(family(t), UNKNOWN)))
            continue
        right, left = stack.pop(), stack.pop()
        if t == "with":
            stack.append((left[0], max(left[1], EXCEPTED)))
        else:
            stack.append((left[0] | right[0], (min if t == "and" else max)(left[1], right[1])))
    return stack[0]


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        a.add_word(f" {phrase} ", phrase)
    a.make_automaton()
    return a


def scan_text(text: str | None) -> dict:
    """Of one whole text: n_words; hits, a list of (phrase, first word's number, words from 0);
    expressions, the texts of those that parse; labels and score. The score is the least of the
    notices' and expressions' freedoms of reuse, 0 without any."""
    words = words_of(text or "")
    joined = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    hits, at, n = [], 0, -1
    found = sorted((end - len(p) - 1, p) for end, p in automaton().iter(joined))
    for start, phrase in found:
        n += joined.count(" ", at, start + 1)
        at = start + 1
        hits.append((phrase, n))
    labels, scores, expressions = set(), [], []
    for phrase, _ in hits:
        if label := BASE.get(phrase) or NOTICES.get(phrase):
            labels.add(label)
            scores.append(FAMILIES[label])
    if tags := [n + len(TAG.split()) - 1 for p, n in hits if p == TAG]:
        # the parser starts where the tag's last word ends
        body = (text or "").encode("utf-8", "surrogatepass")
        ends = [m.end() for m in _WORD.finditer(body.translate(_FOLD))]
        for m in filter(None, (_EXPRESSION.match(body, ends[n]) for n in tags)):
            if value := evaluate(m[1].decode()):
                expressions.append(m[1].decode().strip())
                labels |= value[0]
                scores.append(value[1])
    return {"n_words": len(words), "hits": hits, "expressions": expressions, "labels": sorted(labels), "score": float(min(scores, default=0.0))}


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``{key}``, n_words (long), hits (array of struct phrase, word),
    expressions, labels (arrays of string, labels sorted and distinct), score (double).

    Whole texts are scanned; null and empty ones have no words, hits or labels and score 0. Repeated
    rows and null keys stay as they are; columns other than key and text aren't read.
    """
    hit = pa.list_(pa.struct([("phrase", pa.string()), ("word", pa.int64())]))
    schema = pa.schema([("_key", pa.int64()), ("n_words", pa.int64()), ("hits", hit), ("expressions", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            rows = [scan_text(x.as_py()) for x in b.column(1)]
            hits = [[{"phrase": p, "word": n} for p, n in r["hits"]] for r in rows]
            yield batch(schema, [b.column(0), [r["n_words"] for r in rows], hits, *([r[k] for r in rows] for k in ("expressions", "labels", "score"))])

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(f"`{key}`").cast("bigint").alias("_key"), F.col(f"`{text}`").alias("_text"))
    out = given.mapInArrow(work, "_key bigint, n_words bigint, hits array<struct<phrase:string,word:bigint>>, expressions array<string>, labels array<string>, score double")
    return out.select(F.col("_key").cast(kind).alias(key), *out.columns[1:])


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base = F.filter("hits", lambda h: h.phrase.isin(list(BASE)))
    at = F.transform(base, lambda h: h.word)
    of = F.create_map(*[F.lit(x) for kv in BASE.items() for x in kv])
    labels = F.array_sort(F.array_distinct(F.transform(base, lambda h: F.element_at(of, h.phrase))))
    return scan(docs).select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def license_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op9 that SQL can express."""
    return op9_license_scan(spark, sf_dir).drop("labels", "score")


_PHRASES = ", ".join(f"('{p}', '{label}')" for p, label in BASE.items())
QUERIES = {"op9_license_scan": op9_license_scan, "license_phrases": license_phrases}
ORACLE_SQL = {
    "license_phrases": rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT col0 AS phrase, col1 AS label, string_split(col0, ' ') AS words FROM (VALUES {_PHRASES})),
h AS (SELECT doc_id, i - 1 AS place, label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w) JOIN p ON w[i:i + len(words) - 1] = words),
g AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels FROM h GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels
FROM w LEFT JOIN g USING (doc_id)"""
}
