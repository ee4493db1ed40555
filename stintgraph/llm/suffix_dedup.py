"""Suffix-array dedup: bytes covered by a string of a given length that also starts elsewhere.

1. Every string of that length has an anchor, the part of half its length with the least hash, so
   equal strings have equal anchors. Anchors that occur once can't be in a repeated string.
2. Around each repeated anchor stands a context, the longest stretch whose strings may all have
   that anchor. Contexts with equal bytes repeat as a whole; that they are equal is told by their
   128-bit digests alone, without another look at their bytes.
3. What differs, mostly at the ends of passages, is settled by sorting suffixes of the contexts of an
   anchor (``suffix_sort``), where equal bytes are compared. The group of an anchor with over LARGEST
   different contexts is first split by bytes beside it: a string that begins j bytes before the
   anchor holds all that strings with a j nearby have in common, so ranges of j make narrower
   contexts around longer anchors (WIDTHS), down to the string itself.

Strings of a number of words are found the same way: a text becomes the row of its words' hashes, HASH
bytes each, so that many words are a string of a given length again.

Counts are summed within each worker's portion before anything is shuffled, so neither an anchor nor
a context that a third of the texts hold gathers in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintgraph.llm.jaccard_join import texts_of
from stintgraph.llm.shared import batch, lean, n_shuffle, portions, raw, written
from stintgraph.llm.shingles import U64, groups, words_within
from stintgraph.llm.suffix_sort import anchors, repeated_windows

LENGTH = 400
#: Bytes of a word's hash.
HASH = 8
#: Anchors that a worker holds before it hands them on.
FLUSH = 1 << 19
#: Different contexts of an anchor that one task sorts, and bytes of contexts it sorts at a time.
LARGEST, SORTED_BYTES = 2_000, 1 << 20
#: Strings whose places around an anchor span so many bytes share a context; the first holds them all.
WIDTHS = (1 << 30, 16, 1)
#: Different contexts that a worker remembers before it hands them on.
REMEMBERED = 1 << 16

_PLACES = pa.schema([("bucket", pa.int32()), ("_id", pa.int64()), ("_h", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary()), ("hs", pa.binary()), ("places", pa.binary())])
_PLACES_SQL = "bucket int, _id bigint, _h int, hashes binary, ids binary, hs binary, places binary"


def bodies_of(column: pa.Array) -> list[bytes]:
    return column.to_pylist() if pa.types.is_binary(column.type) else texts_of(column)


def as_words(texts: DataFrame, words: int) -> DataFrame:
    """``texts`` (_id, _h, _text and others) of so many words at least, their words' hashes in place of each text."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            hashes = pa.array([raw(h) if len(h) >= words else None for _, _, h in words_within(texts_of(b.column(2)))], pa.binary())
            made = pa.RecordBatch.from_arrays([*b.columns[:2], hashes, *b.columns[3:]], names=b.schema.names)
            if (long := made.filter(made.column(2).is_valid())).num_rows:
                yield long

    return texts.mapInArrow(lean(work), texts.withColumn("_text", F.col("_text").cast("binary")).schema)


def words_cut(body: bytes, spans: np.ndarray, words: int) -> np.ndarray:
    """Spans of bytes of ``body`` for spans of its words' hashes: whole words, so many at least."""
    first, last = -(-spans[:, 0] // HASH), spans[:, 1] // HASH
    many = last - first >= words
    ((starts, ends, _),) = words_within([body])
    return np.stack([starts[first[many]], ends[last[many] - 1]], 1)


def _by_row(ids: np.ndarray, hs: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """(id, h, places in order) of each text."""
    if not len(ids):
        return
    order = np.lexsort((places, hs, ids))
    ids, hs, places = ids[order], hs[order], places[order]
    new = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (hs[1:] != hs[:-1])]))
    for a, b in zip(new.tolist(), [*new[1:].tolist(), len(ids)], strict=True):
        yield int(ids[a]), int(hs[a]), raw(places[a:b])


def repeated_anchors(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """_id, _h, places: of each text the places of anchors that occur elsewhere as well."""

    def told(rows: Iterable[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        if own := list(rows):
            none = [None] * len(own)
            yield batch(_PLACES, [[x[0] % buckets for x in own], [x[0] for x in own], [x[1] for x in own], none, none, none, [x[2] for x in own]])

    def scatter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def dealt() -> Iterator[pa.RecordBatch]:
            h, ids, hs, places = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.argsort(h, kind="stable")
            h, ids, hs, places = h[order], ids[order], hs[order], places[order]
            new = np.concatenate([[True], h[1:] != h[:-1]])
            first = np.flatnonzero(new)
            many = np.diff(np.append(first, len(h))) > 1
            here = np.repeat(many, np.diff(np.append(first, len(h))))
            yield from told(_by_row(ids[here], hs[here], places[here]))
            # one entry per hash goes on; place -1 says that it was already told, being repeated here
            h, ids, hs, places = h[first], ids[first], hs[first], np.where(many, -1, places[first]).astype(np.int32)
            to = (h % U64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            ends = np.searchsorted(to[order], np.arange(buckets + 1))
            parts = [(k, order[a:b]) for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
            none = [None] * len(parts)
            yield batch(_PLACES, [[k for k, _ in parts], none, none, *([raw(c[p]) for _, p in parts] for c in (h, ids, hs, places))])

        total = 0
        for b in portions(batches):
            bodies = bodies_of(b.column(2))
            ids, hs = b.column(0).to_numpy(), b.column(1).to_numpy()
            for at in groups(bodies):
                sizes = np.array([len(bodies[i]) for i in at])
                ends = np.cumsum(sizes)
                found, h = anchors(np.frombuffer(b"".join([bodies[i] for i in at]), np.uint8), list(zip((ends - sizes).tolist(), ends.tolist(), strict=True)), length)
                if len(found):
                    of = np.searchsorted(ends, found, "right")
                    own = np.array(at)[of]
                    held.append((h, ids[own], hs[own], (found - (ends - sizes)[of]).astype(np.int32)))
                    total += len(found)
            if total >= FLUSH:
                yield from dealt()
                held, total = [], 0
        if held:
            yield from dealt()

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for b in batches:
            done = b.filter(b.column(3).is_null())
            yield from told(zip(*(done.column(i).to_pylist() for i in (1, 2, 6)), strict=True))
            for own, i, kind in zip(columns, (3, 4, 5, 6), (U64, np.int64, np.int32, np.int32), strict=True):
                own += [np.frombuffer(x, kind) for x in b.filter(b.column(3).is_valid()).column(i).to_pylist()]
        if columns[0]:
            h, ids, hs, places = map(np.concatenate, columns)
            order = np.argsort(h, kind="stable")
            h, ids, hs, places = h[order], ids[order], hs[order], places[order]
            twice = np.zeros(len(h), bool)
            twice[1:] = h[1:] == h[:-1]
            twice[:-1] |= twice[1:]
            twice &= places >= 0
            yield from told(_by_row(ids[twice], hs[twice], places[twice]))

    dealt = texts.select("_id", "_h", "_text").mapInArrow(lean(scatter), _PLACES_SQL)
    told_rows = dealt.repartition(buckets, "bucket").mapInArrow(lean(gather), _PLACES_SQL)
    return told_rows.select("_id", "_h", "places").groupBy("_id", "_h").agg(F.collect_list("places").alias("places"))


def _contexts(body: bytes, places: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(anchor's place, least j, largest j) of each place: strings [place - j, place - j + length)."""
    widest = length - length // 2
    for a in places.tolist():
        low, high = max(0, a + length - len(body)), min(widest, a)
        if low <= high:
            yield a, low, high


def _hash64(x: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True)


def _places_of(column: pa.Array) -> list[np.ndarray]:
    return [np.unique(np.concatenate([np.frombuffer(p, np.int32) for p in ps])) for ps in column.to_pylist()]


#: A context (or string): anchor's hash, digest in two halves, text, anchor's place, least and largest j.
_ENTRY = [("anchor", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("_id", pa.int64()), ("_h", pa.int32()), ("place", pa.int32()), ("low", pa.int32()), ("high", pa.int32())]
_ENTRY_SQL = "anchor bigint, x bigint, y bigint, _id bigint, _h int, place int, low int, high int"


def _ranges(low: int, high: int, width: int, widest: int) -> Iterator[tuple[int, int, int, int]]:
    """Parts of low..high that lie in one range of ``width`` each, and the range (up to ``widest``)."""
    for first in range(low - low % width, high + 1, width):
        last = min(first + width - 1, widest)
        yield max(low, first), min(high, last), first, last


def _entries(marked: DataFrame, length: int, width: int) -> DataFrame:
    """An entry for every context of ``marked`` (_id, _h, _text, places), cut to ranges of ``width``, with n, the
    number of equal ones in the same portion; of those one goes on. Its anchor is what all strings of the range hold."""
    schema = pa.schema([*_ENTRY, ("n", pa.int32()), ("told", pa.bool_())])
    widest = length - length // 2

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def dealt() -> pa.RecordBatch:
            rows = [x for x in held.values()]
            return batch(schema, [*map(list, zip(*rows, strict=True))])

        for b in portions(batches):
            repeats: list[tuple] = []
            for i, h, body, places in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), bodies_of(b.column(2)), _places_of(b.column(3)), strict=True):
                for a, low, high in _contexts(body, places, length):
                    for lo, hi, first, last in _ranges(low, high, width, widest):
                        key = hashlib.blake2b(body[a - hi : a - lo + length] + b"%d,%d" % (lo, hi), digest_size=16).digest()
                        if (known := held.get(key)) is None:
                            x, y = (int.from_bytes(key[k : k + 8], "little", signed=True) for k in (0, 8))
                            held[key] = [_hash64(body[a - first : a - last + length] + b"%d" % first), x, y, i, h, a, lo, hi, 1, False]
                            continue
                        if not known[9]:
                            repeats.append((*known[:8], 2, True))
                            known[9], known[8] = True, 2
                        repeats.append((*known[:3], i, h, a, lo, hi, 2, True))
            if repeats:
                # repeated within this portion: told at once, and not sent to be counted again
                yield batch(schema, [*map(list, zip(*[(*r[:8], 0, True) for r in repeats], strict=True))])
            if len(held) >= REMEMBERED:
                yield dealt()
                held.clear()
        if held:
            yield dealt()

    return marked.select("_id", "_h", "_text", "places").mapInArrow(lean(work), f"{_ENTRY_SQL}, n int, told boolean")


def _spans(rows: DataFrame, length: int) -> DataFrame:
    """_id, _h, start, end of the stretch that an entry's strings cover."""
    return rows.select("_id", "_h", (F.col("place") - F.col("high")).alias("start"), (F.col("place") - F.col("low") + length).alias("end"))


def _sorted_spans(shipped: DataFrame, length: int, parts: int) -> DataFrame:
    """Spans of repeated strings of contexts (anchor, _id, _h, place, low, high, context)."""
    out = pa.schema([("_id", pa.int64()), ("_h", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def settled(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[0])
        group = np.unique(np.array([r[0] for r in rows]), return_inverse=True)[1]
        starts = repeated_windows([r[6] for r in rows], np.array([r[5] for r in rows], np.int64), group, length)
        spans: list[tuple[int, int, int, int]] = []
        for (_, i, h, place, _, high, _), own in zip(rows, starts, strict=True):
            if len(own):
                own = np.sort(own) + (place - high)
                cut = np.flatnonzero(np.diff(own) > 1)
                spans += [(i, h, int(own[a]), int(own[b]) + length) for a, b in zip([0, *(cut + 1)], [*cut, len(own) - 1], strict=True)]
        return batch(out, [*map(list, zip(*spans, strict=True))] if spans else [[], [], [], []])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        last = None
        for row in (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)):
            if size >= SORTED_BYTES and row[0] != last:
                yield settled(held)
                held, size = [], 0
            held.append(row)
            size += len(row[6])
            last = row[0]
        if held:
            yield settled(held)

    columns = shipped.select("anchor", "_id", "_h", "place", "low", "high", "context")
    dealt = columns.repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(lean(work), "_id bigint, _h int, start int, end int")


def _with_context(marked: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` entries with the bytes of their contexts."""
    schema = pa.schema([_ENTRY[0], *_ENTRY[3:], ("context", pa.binary())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            rows = [(e["anchor"], i, h, e["place"], e["low"], e["high"], body[e["place"] - e["high"] : e["place"] - e["low"] + length])
                    for i, h, body, es in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), bodies_of(b.column(2)), b.column(3).to_pylist(), strict=True) for e in es]
            if rows:
                yield batch(schema, [*map(list, zip(*rows, strict=True))])

    of = wanted.groupBy("_id", "_h").agg(F.collect_set(F.struct("anchor", "place", "low", "high")).alias("entries"))
    met = marked.join(of, ["_id", "_h"]).select("_id", "_h", "_text", "entries")
    return met.mapInArrow(lean(work), "anchor bigint, _id bigint, _h int, place int, low int, high int, context binary")


def _once_more(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries whose bytes occur in several portions, and one entry for every different context. How
    often each occurs is written first, so that a join with a frequent one can be split."""
    sent = entries.where("n > 0")
    first = F.min(F.struct("_id", "_h", "place", "low", "high"))
    classes = written(sent.groupBy("anchor", "x", "y").agg(F.sum("n").alias("n"), first.alias("one")), "contexts")
    repeated = sent.where("n = 1").join(classes.where("n > 1").select("x", "y"), ["x", "y"], "left_semi")
    return repeated, classes.select("anchor", "x", "y", "n", "one.*")


def repeated_spans(marked: DataFrame, length: int) -> DataFrame:
    """_id, _h, spans: array of struct start, end (ints), of texts (_id, _h, _text: string or binary, and places
    as ``repeated_anchors`` gives them) with a string of ``length`` bytes that also starts elsewhere. Texts without have
    no row."""
    buckets = n_shuffle(marked.sparkSession)
    one_each = marked.dropDuplicates(["_id", "_h"])
    spans: list[DataFrame] = []
    for width in WIDTHS:
        entries = written(_entries(marked, length, width), "entries")
        repeated, classes = _once_more(entries)
        spans += [_spans(entries.where("told"), length), _spans(repeated, length)]
        by_anchor = written(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("different")).where("different > 1"), "anchors")
        open_ = classes.join(by_anchor, "anchor")
        spans.append(_sorted_spans(_with_context(one_each, open_.where(F.col("different") <= LARGEST), length), length, buckets))
        # at the last width a context is the string that is its anchor, so no anchor has several
        if by_anchor.where(F.col("different") > LARGEST).isEmpty():
            break
        of = open_.where(F.col("different") > LARGEST).groupBy("_id", "_h").agg(F.collect_set("place").alias("_place"))
        big = lambda p: F.unhex(F.lpad(F.hex(p), 8, "0"))
        as_bytes = F.transform("_place", lambda p: F.concat(*(F.substring(big(p), k, 1) for k in (4, 3, 2, 1))))
        marked = one_each.drop("places").join(of, ["_id", "_h"]).withColumn("places", as_bytes)
    every = spans[0]
    for x in spans[1:]:
        every = every.unionByName(x)
    return every.dropDuplicates().groupBy("_id", "_h").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans (rows of start, end) in order, those that overlap or touch made one."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > ends[:-1]]))
    return np.stack([spans[new, 0], ends[np.append(new[1:] - 1, len(spans) - 1)]], 1)


def whole_characters(body: bytes, spans: np.ndarray) -> np.ndarray:
    """Spans of UTF-8 widened to whole characters, merged."""
    data = np.frombuffer(body, np.uint8)
    tail = np.append((data & 0xC0) == 0x80, False)
    start, end = spans[:, 0].copy(), spans[:, 1].copy()
    for _ in range(3):
        start -= tail[start] & (start > 0)
        end += tail[end]
    return merged(np.stack([start, end], 1))


def without(body: bytes, spans: np.ndarray) -> bytes:
    ends = [0, *spans[:, 1].tolist()]
    return b"".join([body[a:b] for a, b in zip(ends, [*spans[:, 0].tolist(), len(body)], strict=True)])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, words: int | None = None) -> DataFrame:
    """The columns of ``docs`` and ``_cut``: struct of n_bytes, n_removed (long), spans (the removed
    runs of bytes, array of struct start, end), kept (binary: the other bytes, in order) and text (string: what is
    left where a character goes as a whole if a part of it is removed).

    Strings of ``length`` bytes are removed that also start elsewhere, and where ``words`` is given strings of so many
    words (``[^\\x20\\x09-\\x0D]+``, blanks between them whatever they are) too, however short: words are told by 64-bit hashes.

    Texts are taken as UTF-8; null and empty ones have no bytes. Every occurrence is removed, in every
    row, strings being judged on the whole input. Rows with equal key and text count as so many
    occurrences; null keys are allowed. Keys are whole numbers. Extra columns pass through; none may be named ``_cut``.
    """
    row = F.struct(*[f"`{c}`" for c in docs.columns])
    given = docs.select(row.alias("_row")).select("_row", F.coalesce(F.col(f"_row.`{key}`").cast("bigint"), F.lit(-(1 << 62))).alias("_id"), F.coalesce(F.col(f"_row.`{text}`"), F.lit("")).alias("_text"))
    given = given.withColumn("_h", F.hash("_text"))
    buckets, size = n_shuffle(docs.sparkSession), F.octet_length("_text")
    texts = given.select("_id", "_h", "_text").where(size >= min(length, 2 * words - 1 if words else length))
    places = repeated_anchors(texts.where(size >= length), length, buckets)
    if words:
        # texts meet the places of both kinds at once
        of_words = repeated_anchors(as_words(texts, words), HASH * words, buckets)
        both = written(texts.join(places.join(of_words.withColumnRenamed("places", "of_words"), ["_id", "_h"], "full"), ["_id", "_h"]), "marked")
        marked = both.where("places is not null").select("_id", "_h", "_text", "places")
        by_words = as_words(both.where("of_words is not null").select("_id", "_h", "_text", F.col("of_words").alias("places")), words)
        spans = repeated_spans(marked, length).join(repeated_spans(by_words, HASH * words).withColumnRenamed("spans", "of_words"), ["_id", "_h"], "full")
    else:
        spans = repeated_spans(written(texts.join(places, ["_id", "_h"]), "marked"), length)
        spans = spans.withColumn("of_words", F.lit(None).cast(spans.schema["spans"].dataType))
    met = given.join(spans, ["_id", "_h"], "left").select("_row", "spans", "of_words")
    at = docs.columns.index(text)
    places = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    cut = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", places), ("kept", pa.binary()), ("text", pa.string())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            rows = []
            for body, *own in zip(texts_of(b.column(0).field(at)), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found, of_words = (np.array([(x["start"], x["end"]) for x in o or ()], np.int64).reshape(-1, 2) for o in own)
                if len(of_words):
                    found = np.concatenate([found, words_cut(body, of_words, words)])
                if not len(found):
                    rows.append((len(body), 0, [], body, body))
                    continue
                runs = merged(found)
                rows.append((len(body), int((runs[:, 1] - runs[:, 0]).sum()), [{"start": x, "end": y} for x, y in runs.tolist()], without(body, runs), without(body, whole_characters(body, runs))))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate([pa.int64(), pa.int64(), places, pa.binary(), pa.binary()])]
            columns[4] = pa.Array.from_buffers(pa.string(), len(rows), columns[4].buffers())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.StructArray.from_arrays(columns, fields=list(cut))], names=["_row", "_cut"])

    sql = "struct<n_bytes:bigint,n_removed:bigint,spans:array<struct<start:int,end:int>>,kept:binary,text:string>"
    schema = met.select("_row", F.lit(None).cast(sql).alias("_cut")).schema
    return met.mapInArrow(lean(work), schema).select("_row.*", "_cut")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = remove_repeats(docs)
    return cut.select(
        "doc_id", "_cut.n_bytes", "_cut.n_removed", F.size("_cut.spans").cast("bigint").alias("n_spans"), F.sha2("_cut.kept", 256).alias("kept_sha256"),
        F.octet_length("_cut.kept").cast("bigint").alias("n_kept"), F.col("_cut.text").alias("kept_text"),
    )


QUERIES = {"op7_suffix_dedup": op7_suffix_dedup}
#: String by string and byte by byte: for small tables.
ORACLE_SQL = {"op7_suffix_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT r, x, unnest(range(0, len(x) // 2)) AS p FROM d),
w AS (SELECT r, p, substr(x, 2 * p + 1, 2) AS byte, CASE WHEN p + 400 <= len(x) // 2 THEN md5(substr(x, 2 * p + 1, 800)) END AS h FROM b),
again AS (SELECT h FROM w WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
c AS (SELECT r, p, byte, max(CASE WHEN again.h IS NOT NULL THEN p END) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 399 PRECEDING AND CURRENT ROW) IS NOT NULL AS cut,
  sum(CASE WHEN byte BETWEEN '80' AND 'BF' THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p ROWS UNBOUNDED PRECEDING) AS ch FROM w LEFT JOIN again USING (h)),
e AS (SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY r ORDER BY p), false) AS begins, bool_or(cut) OVER (PARTITION BY r, ch) AS torn FROM c),
a AS (SELECT r, count(*) FILTER (WHERE cut) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans, count(*) FILTER (WHERE NOT cut) AS n_kept,
  coalesce(string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT cut), '') AS kept, coalesce(string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT torn), '') AS whole FROM e GROUP BY r)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256,
  coalesce(n_kept, 0) AS n_kept, decode(unhex(coalesce(whole, ''))) AS kept_text
FROM d LEFT JOIN a USING (r)"""}
