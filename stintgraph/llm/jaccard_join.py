"""N-gram Jaccard join: documents whose sets of word shingles are alike, and their components.

1. Texts with equal sets form a class, told by the digest of the set; keys play no part until the end,
   so rows that repeat one are judged by their own texts.
2. Shingles are counted over all documents, by 32 bits of their hashes in each of as many buckets as
   there are shuffle partitions. A class can only link if ``percent`` of its shingles occur in other
   texts too; all others are their own component. (Bits that collide keep a class too many, never one
   too few.) What follows reads the sets of the classes that are left, and no text.
3. A first round meets the smallest class of a size band that shares one of a class's first shingles:
   most links of groups of copies are found here, a few pairs for each class. Then shingles are counted
   anew, by components: only classes of which ``percent`` occurs in other components go on.
4. Sets are ordered frequent shingles last. Two sets alike enough share one of their first
   ``n - ceil(t n) + 1`` shingles; classes meet in groups by such a shingle, where the group holds
   classes of several components. The order decides the cost, never the result.
5. A group is cut into tiles by size band; tiles meet whose bands allow the similarity. Signatures of
   some SPARSE hashed bits per shingle bound the overlap from above: sets differ in at least as many
   shingles as their signatures differ in bits. What is left is decided by exact intersection of the
   sorted arrays.

Tiles are looked at in rounds, and components grow with the links found: a class meets only the one
that its signature is most like outside its own component, NEAREST_ROUNDS times or until no link is found; then
all meet, but for pairs within a component, which need no further link. No group is expanded into all its pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stintgraph.llm.components import connected_components
from stintgraph.llm.shared import batch, lean, n_shuffle, portions, raw, written
from stintgraph.llm.shingles import U64, shingle_sets

WIDTH, PERCENT = 5, 75
#: Bits of a signature: the power of two next above SPARSE times the set's size, within these.
SPARSE, LEAST_BITS, MOST_BITS = 6, 512, 1 << 19
#: A worker counts, and hands on, so many shingles at a time.
FLUSH = 1 << 20
#: It holds so many classes at most (their places are told in 16 bits).
MOST_CLASSES = 60_000
#: Shingles that are this frequent within one such portion are summed up over all; at most
#: ORDERED_LAST of them, the most frequent, are ordered behind all others.
FREQUENT, ORDERED_LAST = 4, 1 << 18
#: Shingles of a class that the first round looks at.
FIRST = 4
#: Rounds in which a class meets only the one most like it, before the round of all that are left.
NEAREST_ROUNDS = 3
#: Documents in a tile.
TILE = 1024


def texts_of(column: pa.Array) -> list[bytes]:
    return [(x or "").encode("utf-8", "surrogatepass") for x in column.to_pylist()]


def signature(hashes: np.ndarray) -> bytes:
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (SPARSE * len(hashes)).bit_length()))
    bits = np.zeros(size, bool)
    bits[(hashes & U64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def class_of(hashes: np.ndarray) -> int:
    """The number of a set's class: 64 bits of its digest."""
    return int.from_bytes(hashlib.blake2b(raw(hashes), digest_size=16).digest()[:8], "little", signed=True)


def folded(bits: bytes, size: int) -> np.ndarray:
    """The signature as it would be with ``size`` bytes, in words."""
    words = np.frombuffer(bits, U64)
    while len(words) * 8 > size:
        words = words[: len(words) // 2] | words[len(words) // 2 :]
    return words


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def in_order(hashes: np.ndarray, frequent: np.ndarray, ranks: np.ndarray, need: int) -> np.ndarray:
    """The first ``need`` shingles: those not in ``frequent`` (sorted) by hash, then the others by
    their place in ``ranks``, rarest first."""
    need = max(0, need)
    if not len(frequent):
        return hashes[:need]
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    known = frequent[at] == hashes
    rare = hashes[~known]
    if len(rare) >= need:
        return rare[:need]
    late = hashes[known][np.argsort(ranks[at[known]], kind="stable")]
    return np.concatenate([rare, late[: need - len(rare)]])


def by_bucket(held: dict[int, np.ndarray], buckets: int) -> tuple[int, np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Of classes and their sets: the portion's number, its classes, and of each bucket with shingles its
    number, 32 bits of every shingle, and the place of each one's class."""
    h, at = np.concatenate(list(held.values())), np.repeat(np.arange(len(held)), [len(x) for x in held.values()])
    to = (h % U64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
    order = np.argsort(to, kind="stable")
    ends = np.searchsorted(to[order], np.arange(buckets + 1))
    bits, classes = (h // U64(buckets)).astype(np.uint32), np.array(list(held), np.int64)
    parts = [order[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return class_of(classes), classes, [(k, bits[p], at[p]) for k, p in enumerate(parts) if len(p)]


def described(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """kind 0, a document: _id, n, whole (digest of its set), _class; kind 1, a worker's portion: its number and
    classes; kind 3: of a portion in a bucket the places of classes, once for every shingle they share.
    A portion's number is a digest of its classes, so that one that a repeated task made otherwise is told."""
    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("_id", pa.int64()), ("n", pa.int64()), ("whole", pa.binary()), ("_class", pa.int64()), ("portion", pa.int64()), ("packed", pa.binary()), ("places", pa.binary())])
    sql = "kind int, bucket int, _id bigint, n bigint, whole binary, _class bigint, portion bigint, packed binary, places binary"

    def scatter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        total = 0

        def dealt() -> pa.RecordBatch:
            portion, classes, parts = by_bucket(held, buckets)
            m, none = 1 + len(parts), [None] * (1 + len(parts))
            return batch(schema, [[1] + [2] * len(parts), [portion % buckets, *(k for k, _, _ in parts)], none, none, none, none, [portion] * m,
                                  [raw(classes), *(raw(x) for _, x, _ in parts)], [None, *(raw(np.diff(x, prepend=0).astype(np.uint16)) for _, _, x in parts)]])

        for b in portions(batches):
            sets = shingle_sets(texts_of(b.column(1)), width)
            classes, none = [class_of(s) for s in sets], [None] * len(sets)
            yield batch(schema, [[0] * len(sets), [c % buckets for c in classes], b.column(0), [len(s) for s in sets], [hashlib.blake2b(raw(s), digest_size=16).digest() for s in sets], classes, none, none, none])
            for key, doc_id, s in zip(classes, b.column(0).to_pylist(), sets, strict=True):
                if len(s) and doc_id is not None and key not in held:
                    held[key] = s
                    total += len(s)
                    if total >= FLUSH or len(held) == MOST_CLASSES:
                        yield dealt()
                        held.clear()
                        total = 0
        if held:
            yield dealt()

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bits, places = [], [], []
        for b in batches:
            sent = pa.compute.equal(b.column(0), 2)
            yield b.filter(pa.compute.invert(sent))
            b = b.filter(sent)
            numbers += b.column(6).to_pylist()
            bits += [np.frombuffer(x.as_py(), np.uint32) for x in b.column(7)]
            places += [np.frombuffer(x.as_py(), np.uint16) for x in b.column(8)]
        if not bits:
            return
        every = np.sort(np.concatenate(bits))
        often = every[1:][every[1:] == every[:-1]]
        del every
        for number, own, steps in zip(numbers, bits, places, strict=True):
            at = np.minimum(np.searchsorted(often, own), max(0, len(often) - 1))
            shared = np.cumsum(steps, dtype=np.int64)[often[at] == own] if len(often) else steps[:0]
            if len(shared):
                yield batch(schema, [[3], [None], [None], [None], [None], [None], [number], [None], [raw(shared.astype(np.uint16))]])

    given = docs.select("_id", "_text").mapInArrow(lean(scatter), sql)
    return given.repartition(buckets, "bucket").mapInArrow(lean(gather), sql).drop("bucket")


def shared_shingles(rows: DataFrame) -> DataFrame:
    """_class, shared: how many shingles of a class occur in other texts, at most; those with none are left out."""
    schema = pa.schema([("_class", pa.int64()), ("shared", pa.int64())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, classes, counts = None, np.empty(0, np.int64), np.empty(0, np.int64)

        def told() -> pa.RecordBatch:
            some = counts > 0
            return batch(schema, [classes[some], counts[some]])

        for b in batches:
            for kind, portion, packed, places in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == 1 and portion != number:
                    yield told()
                    number, classes = portion, np.frombuffer(packed, np.int64)
                    counts = np.zeros(len(classes), np.int64)
                elif kind == 3:
                    if portion != number:
                        raise ValueError("a portion was made anew from other rows while its shingles were counted")
                    counts += np.bincount(np.frombuffer(places, np.uint16), minlength=len(classes))
        yield told()

    sent = rows.where("kind in (1, 3)").select("kind", "portion", "packed", "places").repartition("portion").sortWithinPartitions("portion", "kind")
    return sent.mapInArrow(lean(work), "_class bigint, shared bigint").groupBy("_class").agg(F.max("shared").alias("shared"))


def crossing(sets: DataFrame, components: DataFrame, percent: int, buckets: int) -> DataFrame:
    """The rows of ``sets`` of which ``percent`` of the shingles occur in classes of other components as well
    (no other can link outside its own), and these shingles as ``crossing``: the bucket and 32 bits of each, in 64
    bits. Counted as by ``described``, but over components."""
    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("portion", pa.int64()), ("packed", pa.binary()), ("places", pa.binary()), ("components", pa.binary())])
    sql = "kind int, bucket int, portion bigint, packed binary, places binary, components binary"

    def scatter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        of: list[int] = []
        total = 0

        def dealt() -> pa.RecordBatch:
            portion, classes, parts = by_bucket(held, buckets)
            sizes = raw(np.array([len(x) for x in held.values()], np.int64))
            component, rows = np.array(of, np.int64), [(1, portion % buckets, portion, raw(classes), sizes, None)]
            for k, bits, at in parts:
                steps = np.diff(at, prepend=0)
                first = np.concatenate([[True], steps[1:] > 0])
                rows.append((2, k, portion, raw(bits), raw(steps.astype(np.uint16)), raw(component[at[first]])))
            return batch(schema, [*map(list, zip(*rows, strict=True))])

        for b in portions(batches):
            for key, component, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held[key] = np.frombuffer(packed, U64)
                of.append(component)
                total += len(held[key])
                if total >= FLUSH or len(held) == MOST_CLASSES:
                    yield dealt()
                    held.clear()
                    of.clear()
                    total = 0
        if held:
            yield dealt()

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bits, places, components = [], [], [], []
        for b in batches:
            sent = pa.compute.equal(b.column(0), 2)
            yield b.filter(pa.compute.invert(sent))
            b = b.filter(sent)
            numbers += zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)
            for own, steps, of in zip(*(b.column(k).to_pylist() for k in (3, 4, 5)), strict=True):
                bits.append(np.frombuffer(own, np.uint32))
                at = np.frombuffer(steps, np.uint16).astype(np.int64)
                components.append(np.frombuffer(of, np.int64)[np.cumsum(np.concatenate([[0], at[1:] > 0]))])
                places.append(np.cumsum(at).astype(np.uint16))
        if not bits:
            return
        every, component = np.concatenate(bits), np.concatenate(components)
        order = np.argsort(every, kind="stable")
        ranked, component = every[order], component[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        mixed = np.minimum.reduceat(component, first) != np.maximum.reduceat(component, first)
        shared = np.empty(len(every), bool)
        shared[order] = np.repeat(mixed, np.diff(np.append(first, len(every))))
        ends = np.cumsum([len(x) for x in bits])
        for (k, number), x, at, own in zip(numbers, bits, places, np.split(shared, ends[:-1]), strict=True):
            if own.any():
                yield batch(schema, [[3], [k], [number], [raw(x[own])], [raw(at[own])], [None]])

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("_class", pa.int64()), ("crossing", pa.binary())])
        number, classes, sizes, at, keys = None, np.empty(0, np.int64), np.empty(0, np.int64), [], []

        def enough() -> pa.RecordBatch:
            if not at:
                return batch(out, [[], []])
            place, key = np.concatenate(at), np.concatenate(keys)
            order = np.argsort(place, kind="stable")
            first = np.searchsorted(place[order], np.arange(len(classes) + 1))
            rows = [(int(classes[i]), raw(key[order[a:b]])) for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)) if (b - a) * 100 >= sizes[i] * percent]
            return batch(out, [*map(list, zip(*rows, strict=True))] if rows else [[], []])

        for b in batches:
            for kind, k, portion, packed, places in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == 1 and portion != number:
                    yield enough()
                    number, classes, sizes, at, keys = portion, np.frombuffer(packed, np.int64), np.frombuffer(places, np.int64), [], []
                elif kind == 3:
                    if portion != number:
                        raise ValueError("a portion was made anew from other rows while its shingles were counted")
                    at.append(np.frombuffer(places, np.uint16))
                    keys.append((U64(k) << U64(32)) | np.frombuffer(packed, np.uint32).astype(U64))
        yield enough()

    # in order of classes, so that a task made anew makes the same portions
    placed = sets.select("_class", "hashes").join(components.withColumnsRenamed({"node": "_class"}), "_class", "left")
    given = placed.select("_class", F.coalesce("component", "_class").alias("component"), "hashes").sortWithinPartitions("_class").mapInArrow(lean(scatter), sql)
    marked = given.repartition(buckets, "bucket").mapInArrow(lean(gather), sql).drop("components")
    sent = marked.repartition("portion").sortWithinPartitions("portion", "kind").select("kind", "bucket", "portion", "packed", "places")
    found = written(sent.mapInArrow(lean(told), "_class bigint, crossing binary"), "crossing")
    return sets.join(found, "_class")


def sets_of(docs: DataFrame, near: DataFrame, width: int) -> DataFrame:
    """_class, n, bits, hashes of the classes in ``near`` (_class, least), each made of a row of its least
    key; other texts of that key are left out again."""
    schema = pa.schema([("_class", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("hashes", pa.binary())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            found = shingle_sets(texts_of(b.column(0)), width)
            yield batch(schema, [[class_of(s) for s in found], [len(s) for s in found], [signature(s) for s in found], [raw(s) for s in found]])

    # as many classes as documents may be near: never broadcast
    own = docs.join(near.select(F.col("least").alias("_id")).dropDuplicates().hint("merge"), "_id", "left_semi").select("_text")
    found = own.mapInArrow(lean(work), "_class bigint, n bigint, bits binary, hashes binary").join(near.select("_class"), "_class", "left_semi")
    return found.dropDuplicates(["_class"])


def frequent_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of at most ORDERED_LAST frequent shingles: hashes, sorted, and each one's place from rare to frequent."""
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            return batch(schema, [values[n >= FREQUENT].view(np.int64), n[n >= FREQUENT]])

        for b in portions(batches):
            held += [np.frombuffer(x, U64) for x in b.column(0).to_pylist()]
            if sum(map(len, held)) >= FLUSH:
                yield counted()
                held = []
        if held:
            yield counted()

    counts = sets.select("hashes").mapInArrow(lean(work), "h bigint, n bigint")
    top = counts.groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "h").limit(ORDERED_LAST).collect()
    hashes = np.array([r.h for r in top], np.int64).view(U64)
    order = np.argsort(hashes)
    return hashes[order], (len(top) - np.arange(len(top)))[order]


def prefixes(sets: DataFrame, frequent: tuple[np.ndarray, np.ndarray], percent: int, buckets: int = 0) -> DataFrame:
    """_class, n, prefix: the first shingles of every set, as one binary. Where ``sets`` has ``crossing`` (told
    by ``buckets``), all others come first, and are left out, as they meet nothing."""
    spread = sets.sparkSession.sparkContext.broadcast(frequent)

    def crossed(h: np.ndarray, packed: bytes) -> bytes:
        keys = ((h % U64(buckets)) << U64(32)) | (h // U64(buckets)).astype(np.uint32).astype(U64)
        own = h[np.isin(keys, np.frombuffer(packed, U64))]
        return raw(in_order(own, *spread.value, prefix_length(len(h), percent) - (len(h) - len(own))))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            hashes = [np.frombuffer(x, U64) for x in b.column(2).to_pylist()]
            if buckets:
                own = [crossed(h, x) for h, x in zip(hashes, b.column(3).to_pylist(), strict=True)]
            else:
                own = [raw(in_order(h, *spread.value, prefix_length(len(h), percent))) for h in hashes]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(own, pa.binary())], names=["_class", "n", "prefix"])

    return sets.select("_class", "n", "hashes", *["crossing"] * bool(buckets)).mapInArrow(lean(work), "_class bigint, n bigint, prefix binary")


def size_band(n: Column, percent: int) -> Column:
    """Sets alike enough are in one band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / math.log(max(100 / percent, 1.001)))


def first_pairs(firsts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of a class with the smallest one of its size band that shares one of its FIRST first
    shingles. The smallest ones are written first, so that the join with a frequent shingle can be split."""
    schema = pa.schema([("h", pa.int64()), ("_class", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            own = [np.frombuffer(x, np.int64)[:FIRST] for x in b.column(2).to_pylist()]
            each = [len(x) for x in own]
            if sum(each):
                yield batch(schema, [np.concatenate(own), *(np.repeat(b.column(k).to_numpy(), each) for k in (0, 1))])

    entries = firsts.select("_class", "n", "prefix").mapInArrow(lean(work), "h bigint, _class bigint, n bigint").withColumn("band", size_band(F.col("n"), percent))
    least = entries.groupBy("h", "band").agg(F.min(F.struct("n", "_class")).alias("_lead"), F.count(F.lit(1)).alias("m")).where("m > 1")
    met = entries.join(written(least.select("h", "band", F.col("_lead._class").alias("_lead")), "leads"), ["h", "band"]).where("_lead <> _class")
    return met.select(F.least("_lead", "_class").alias("a"), F.greatest("_lead", "_class").alias("b")).dropDuplicates()


def meeting_groups(firsts: DataFrame, components: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Of groups by a shingle of ``firsts`` that hold classes of several components: kind 0, a pair (a < b)
    that is such a group; kind 1, the classes of larger ones as one binary. Groups of the same two least classes
    are told as one: those of near copies have much the same members."""
    entry = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary()), ("sizes", pa.binary()), ("components", pa.binary())])
    kinds = (U64, np.int64, np.int64, np.int64)

    def scatter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            own = [np.frombuffer(x, U64) for x in b.column(3).to_pylist()]
            each = [len(x) for x in own]
            if not sum(each):
                continue
            columns = [np.concatenate(own), *(np.repeat(b.column(k).to_numpy(), each) for k in range(3))]
            to = (columns[0] % U64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            ends = np.searchsorted(to[order], np.arange(buckets + 1))
            parts = [(k, order[x:y]) for k, (x, y) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if y > x]
            yield batch(entry, [[k for k, _ in parts], *([raw(c[p]) for _, p in parts] for c in columns)])

    out = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("members", pa.binary())])

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for b in batches:
            for own, c, kind in zip(columns, b.columns[1:], kinds, strict=True):
                own += [np.frombuffer(x.as_py(), kind) for x in c]
        if not columns[0]:
            return
        h, ids, sizes, component = map(np.concatenate, columns)
        order = np.lexsort((ids, h))
        h, ids, sizes, component = h[order], ids[order], sizes[order], component[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        lengths = np.diff(np.append(first, len(h)))
        mixed = np.minimum.reduceat(component, first) != np.maximum.reduceat(component, first)
        two = first[mixed & (lengths == 2)]
        two = two[np.minimum(sizes[two], sizes[two + 1]) * 100 >= np.maximum(sizes[two], sizes[two + 1]) * percent]
        if len(two):
            pairs = np.unique(np.stack([ids[two], ids[two + 1]], 1), axis=0)
            yield batch(out, [[0] * len(pairs), pairs[:, 0], pairs[:, 1], [None] * len(pairs)])
        families: dict[bytes, list[np.ndarray]] = {}
        more = mixed & (lengths > 2)
        for a, n in zip(first[more].tolist(), lengths[more].tolist(), strict=True):
            families.setdefault(raw(ids[a : a + 2]), []).append(ids[a : a + n])
        lists = [raw(np.unique(np.concatenate(x))) for x in families.values()]
        for k in range(0, len(lists), 1000):
            own = lists[k : k + 1000]
            yield batch(out, [[1] * len(own), [None] * len(own), [None] * len(own), own])

    placed = firsts.join(components.withColumnsRenamed({"node": "_class"}), "_class", "left").select("_class", "n", F.coalesce("component", "_class").alias("component"), "prefix")
    dealt = placed.mapInArrow(lean(scatter), "bucket int, hashes binary, ids binary, sizes binary, components binary")
    return dealt.repartition(buckets, "bucket").mapInArrow(lean(gather), "kind int, a bigint, b bigint, members binary")


def overlap_allowed(differ: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of together ``sizes`` shingles, whose signatures differ in so many bits, may be alike."""
    # overlap <= (sizes - differ) / 2, and 100 * overlap >= percent * (sizes - overlap) is needed
    return (100 + percent) * (sizes - differ) >= 2 * percent * sizes


def allowed(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a < b) of classes that sizes and signatures allow."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sides = zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)
                differ = [int(np.bitwise_count(folded(x, len(y)) ^ folded(y, len(x))).sum()) for x, y in sides]
                keep = overlap_allowed(np.array(differ), b.column(4).to_numpy() + b.column(5).to_numpy(), percent)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    of = lambda k: nodes.select(F.col("_class").alias(k), F.col("n").alias(f"{k}_n"))
    met = pairs.join(of("a"), "a").join(of("b"), "b")
    reps = met.where(F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent).select("a", "b")
    side = lambda k: nodes.select(F.col("_class").alias(k), F.col("bits").alias(f"{k}_bits"), F.col("n").alias(f"{k}_n"))
    signed = written(reps, "pairs").join(side("a"), "a").join(side("b"), "b")
    return signed.select("a", "b", "a_bits", "b_bits", "a_n", "b_n").mapInArrow(lean(work), "a bigint, b bigint")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose sets are alike, by exact intersection of the sorted arrays."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            keep = []
            for left, right in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(left.as_py(), U64), np.frombuffer(right.as_py(), U64)
                both = np.intersect1d(x, y, assume_unique=True).size
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda k: sets.select(F.col("_class").alias(k), F.col("hashes").alias(f"{k}_hashes"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_hashes", "b_hashes")
    return met.mapInArrow(lean(work), "a bigint, b bigint")


def members_of(groups: DataFrame) -> DataFrame:
    """_group, rep of groups that are told as binaries of classes in order; those of the same two least are one."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m in b.column(0).to_pylist():
                ids = np.frombuffer(m, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), class_of(ids[:2].view(U64)))), pa.array(ids)], names=["_group", "rep"])

    return groups.select("members").mapInArrow(lean(work), "_group bigint, rep bigint").dropDuplicates()


def across(members: DataFrame, nodes: DataFrame, components: DataFrame, percent: int, nearest: bool = False) -> DataFrame:
    """Pairs of the groups' members in different components that sizes and signatures allow; with
    ``nearest`` only each member's most alike by signature. A group's classes are cut into
    size bands and those into tiles of TILE at most on average; a task gets two tiles."""
    places = nodes.select(F.col("_class").alias("rep"), "n").join(components.withColumnsRenamed({"node": "rep"}), "rep", "left").select("rep", "n", F.coalesce("component", "rep").alias("component"))
    known = written(members.join(places, "rep").select("_group", "rep", "component", "n"), "placed")
    range_ = lambda c: (F.min(c).alias(f"_low_{c}"), F.max(c).alias(f"_high_{c}"))
    mixed = known.groupBy("_group").agg(*range_("component"), *range_("n"), F.count(F.lit(1)).alias("m")).where("_low_component <> _high_component")
    mixed = written(mixed.drop("_low_component", "_high_component"), "mixed")
    own = known.join(mixed, "_group").join(nodes.select(F.col("_class").alias("rep"), "bits"), "rep")
    # small groups are one tile; in others size bands are a factor of 100 / percent wide: sets meet within a band and with the next one
    tiles = F.ceil(F.col("m") / TILE).cast("bigint")
    of_size = lambda c: F.when(tiles > 1, size_band(F.col(c), percent)).otherwise(0)
    band = of_size("n")
    ranked = own.withColumns({"_tiles": tiles, "_band": band}).withColumn("_tile", F.col("_band") * F.col("_tiles") + F.pmod(F.xxhash64("rep"), "_tiles"))
    # only bands that the group has
    first, last = F.greatest(F.col("_band") - 1, of_size("_low_n")), F.least(F.col("_band") + 1, of_size("_high_n"))
    beside = F.when(tiles > 1, F.sequence(first * F.col("_tiles"), (last + 1) * F.col("_tiles") - 1)).otherwise(F.array(F.col("_tile")))
    left = ranked.select("*", F.explode(beside).alias("_other"))
    meet = left.withColumns({"_x": F.least("_tile", "_other"), "_y": F.greatest("_tile", "_other")})

    def tile(rows: list[tuple], same: bool) -> Iterator[np.ndarray]:
        rows.sort(key=lambda r: r[6])
        at, rep, comp, n = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 5, 6))
        size = np.array([len(r[7]) for r in rows])
        # sets from the first of a signature's size on, all folded to it
        of = {k: (first := int(np.searchsorted(size, k)), np.stack([folded(r[7], k) for r in rows[first:]])) for k in np.unique(size).tolist()}
        for i in range(len(rep) - 1):
            first, bits = of[int(size[i])]
            j = np.arange(i + 1, np.searchsorted(n, n[i] * 100 // percent, "right"))
            j = j[(comp[j] != comp[i]) & (same | (at[j] != at[i]))]
            if len(j):
                differ = np.bitwise_count(bits[j - first] ^ bits[i - first]).sum(1, dtype=np.int64)
                keep = overlap_allowed(differ, n[j] + n[i], percent)
                j, differ = j[keep], differ[keep]
                if nearest and len(j):
                    j = j[[np.argmin(differ / (n[j] + n[i]))]]
                yield np.stack([np.minimum(rep[j], rep[i]), np.maximum(rep[j], rep[i])], 1)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        found: set[tuple[int, int]] = set()
        for (_, x, y), own in groupby(rows, key=lambda r: r[:3]):
            for pairs in tile(list(own), x == y):
                found.update(map(tuple, pairs.tolist()))
            if len(found) >= 1 << 16:
                yield batch(out, [*map(list, zip(*found, strict=True))])
                found.clear()
        if found:
            yield batch(out, [*map(list, zip(*found, strict=True))])

    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    columns = meet.select("_group", "_x", "_y", "_tile", "rep", "component", "n", "bits")
    tiled = columns.repartition("_group", "_x", "_y").sortWithinPartitions("_group", "_x", "_y")
    return tiled.mapInArrow(lean(work), "a bigint, b bigint").dropDuplicates(["a", "b"])


def judged(docs: DataFrame, key: str, text: str, width: int, percent: int) -> DataFrame:
    """_id, n, _class, _component, _least: for every row of ``docs`` its key, size, class, the component's
    number and its least key; the last two null for rows that link with nothing by themselves."""
    buckets = n_shuffle(docs.sparkSession)
    given = docs.select(F.col(f"`{key}`").cast("bigint").alias("_id"), F.col(f"`{text}`").alias("_text"))
    rows = written(described(given, width, buckets), "shingles")
    slim = rows.where("kind = 0").select("_id", "n", "_class")
    whole = rows.where("kind = 0 and n > 0 and _id is not null")
    one = F.when(F.min("whole") == F.max("whole"), F.min("_id")).otherwise(F.raise_error(F.lit("two sets share a class number")).cast("bigint"))
    classes = whole.groupBy("_class").agg(one.alias("least"), F.first("n").alias("n"))
    nodes = written(classes.join(shared_shingles(rows), "_class", "left").select("_class", "least", "n", F.coalesce("shared", F.lit(0)).alias("shared")), "nodes")
    near = nodes.where(F.col("shared") * 100 >= F.col("n") * percent)
    sets = written(sets_of(given, near, width), "sets")
    components = tested = None

    def look(pairs: DataFrame) -> bool:
        """Components grow with those of ``pairs`` that link; whether any does."""
        nonlocal components, tested
        fresh = written(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        links = written(linked(fresh, sets, percent), "alike")
        tested = fresh if tested is None else tested.unionByName(fresh)
        if components is None:
            components = written(connected_components(links), "components")
            return True
        if links.isEmpty():
            return False
        stars = components.select(F.col("node").alias("a"), F.col("component").alias("b"))
        components = written(connected_components(stars.unionByName(links)), "components")
        return True

    look(allowed(first_pairs(prefixes(sets, frequent_shingles(sets), percent), percent), sets, percent))
    sets = written(crossing(sets, components, percent, buckets), "crossing-sets")
    firsts = written(prefixes(sets, frequent_shingles(sets), percent, buckets), "prefixes")
    met = written(meeting_groups(firsts, components, percent, buckets), "groups")
    twos = allowed(met.where("kind = 0").select("a", "b").dropDuplicates(), sets, percent)
    lists = written(members_of(met.where("kind = 1")), "members")
    look(twos.unionByName(across(lists, sets, components, percent, nearest=True)).dropDuplicates())
    for _ in range(NEAREST_ROUNDS - 1):
        if not look(across(lists, sets, components, percent, nearest=True)):
            break
    look(across(lists, sets, components, percent))
    places = nodes.select("_class", "least").join(components.withColumnsRenamed({"node": "_class", "component": "_component"}), "_class", "left")
    places = written(places.select("_class", "least", F.coalesce("_component", "_class").alias("_component")), "places")
    # written, so that the join with a component of very many classes can be split
    least = written(places.groupBy("_component").agg(F.min("least").alias("_least")), "least")
    told = places.select("_class", "_component").join(least, "_component")
    linking = (F.col("n") > 0) & F.col("_id").isNotNull()
    found = slim.join(written(told, "told"), "_class", "left")
    return found.select("_id", "n", "_class", *(F.when(linking, F.col(c)).alias(c) for c in ("_component", "_least")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``{key}``, n_shingles (long), component_id: for every row of ``docs`` the least key that links lead to.

    Two documents link if their sets' intersection is at least ``percent`` hundredths of their union.
    Sets without shingles (null, empty and blank texts) link with nothing, and a document without
    links is its own component. Rows with a null key get a null component and link with nothing.
    Of rows that repeat a key each is judged by its own text. Extra columns aren't read.
    """
    kind = docs.schema[key].dataType.simpleString()
    found = judged(docs, key, text, width, percent)
    return found.select(F.col("_id").cast(kind).alias(key), F.col("n").alias("n_shingles"), F.coalesce("_least", "_id").cast(kind).alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row of each component, of its least key (and all rows with a null key or without shingles).
    Of several such rows that with the least class stays, then the one with the least text."""

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in portions(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(map(class_of, shingle_sets(texts_of(b.column(1)), width)), pa.int64())], names=["_row", "_text", "_class"])

    found = written(judged(docs, key, text, width, percent), "judged")
    linking = found.where("_component is not null")
    others = linking.where("_id <> _least").select("_id").dropDuplicates()
    repeated = written(linking.groupBy("_id").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("_id"), "repeated")
    kept = linking.where("_id = _least").groupBy("_component").agg(F.min(F.struct("_id", "_class")).alias("k")).select("k._id", "k._class")
    rows = docs.select(F.struct("*").alias("_row"), F.col(f"`{text}`").alias("_text"), F.col(f"`{key}`").cast("bigint").alias("_id"))
    single = rows.join(repeated, "_id", "left_anti").join(others, "_id", "left_anti").select("_row")
    # where a key stands for several rows, the row's own text decides
    many = rows.join(repeated, "_id", "left_semi")
    schema = many.select("_row", "_text").schema.add("_class", "long")
    classed = many.select("_row", "_text").mapInArrow(lean(sets), schema).withColumn("_id", F.col(f"_row.`{key}`").cast("bigint"))
    order = Window.partitionBy("_id", "_class").orderBy("_text")
    own = classed.join(kept, ["_id", "_class"], "left_semi").withColumn("_k", F.row_number().over(order)).where("_k = 1").select("_row")
    none = classed.where(F.col("_class") == class_of(np.empty(0, U64))).select("_row")
    return single.unionByName(own).unionByName(none).select("_row.*")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op8_jaccard_join": op8_jaccard_join}
ORACLE_SQL = {"op8_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
c AS (SELECT list_sort(g) AS g, min(doc_id) AS rep, len(list_sort(g)) AS n FROM s GROUP BY list_sort(g)),
e AS (SELECT rep, n, unnest(g) AS h FROM c),
p AS (SELECT a.rep AS a, b.rep AS b FROM e a JOIN e b ON a.h = b.h AND a.rep < b.rep WHERE least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 75
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT a AS node, a AS low FROM l UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.node WHERE r.low < l.b),
m AS (SELECT node, min(low) AS low FROM r GROUP BY node)
SELECT doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, CASE WHEN len(s.g) = 0 THEN doc_id ELSE coalesce(m.low, c.rep) END AS component_id
FROM s LEFT JOIN c ON list_sort(s.g) = c.g LEFT JOIN m ON m.node = c.rep"""}
