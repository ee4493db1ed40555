"""SentencePiece encoding and decoding through a relational lattice of distinct words.

1. A text is parted into words that no piece crosses. Each portion of a worker's texts gives its
   distinct words once, packed by bucket; a bucket makes them distinct over all portions.
2. Substrings of bounded length of every distinct word are equi-joined to the piece table; the edges
   found are grouped by word, where the words already are.
3. A fold by Spark's higher-order aggregate picks a word's pieces: Viterbi's best path for piece
   tables of unigram scores; for tables of merges, whose scores are ranks and whose right result isn't
   the path of the largest sum, the best edge that joins two neighbours, until none does. The places
   where a word is parted are the bits of one number there.
4. The words' ids go back to the portions that asked for them, in the order of the words and without
   them, as files in the shared folder, and each portion is put together from its own words. Order and
   number are held against a digest of the words; a portion that isn't what it was is an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.dataset as ds
import sentencepiece
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stintgraph.llm.shared import batch, fresh_path, lean, n_shuffle, portions, raw

SPACE = "▁"
#: Longer words, as texts without blanks have them, don't fit the bits of a number: they are folded in Python
#: where they stand, to the same ids, in time that hardly grows beyond their length.
LONGEST = 60
#: Bytes of text in a portion, and the most pieces a table may have, to be sent to every worker.
PORTION, MOST_PIECES = 24 << 20, 1 << 20
#: Words whose edges a task groups before it sorts instead.
GROUPED = 1 << 18
#: A word: blanks and what follows up to the next ones; a line's end stands alone.
WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
#: What a character that no piece holds costs in Viterbi's paths, below the worst score.
UNKNOWN = 10.0


@dataclass(frozen=True, eq=False)
class Pieces:
    """A piece table: pieces with ids and scores, ids of bytes (or none), the id of unknown ones."""

    pieces: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]
    unknown: int
    merges: bool

    @staticmethod
    def load(model: str, merges: bool = True) -> Pieces:
        m = sentencepiece.SentencePieceProcessor(model_file=model)
        n = m.get_piece_size()
        own = tuple((m.id_to_piece(i), i, m.get_score(i)) for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)))
        return Pieces(own, tuple(i for i in range(n) if m.is_byte(i)), m.unk_id(), merges)

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.pieces), default=1)


@lru_cache(2)
def _lookup(table: Pieces) -> tuple[dict[str, tuple[int, float]], dict[int, bytes]]:
    """(id, score) by piece, UTF-8 bytes by id."""
    by_piece = {p: (i, s) for p, i, s in table.pieces}
    by_id = {i: p.encode() for p, i, _ in table.pieces} | {i: bytes([b]) for b, i in enumerate(table.byte_ids)}
    return by_piece, by_id


def words_of(text: str) -> list[str]:
    """Words of a text whose blanks are marked and before which one is set; an empty text has none. A
    mark that the text itself holds is taken for a blank, and decoded to one."""
    if not text:
        return []
    if text[0] == " " or "  " in text or SPACE in text:
        return WORDS.findall(SPACE + text.replace(" ", SPACE))
    marked = SPACE + text.replace(" ", f" {SPACE}")
    return [w for w in marked.replace("\n", " \n ").split(" ") if w] if "\n" in text else marked.split(" ")


def _unknown_ids(char: str, table: Pieces) -> list[int]:
    return [table.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")] if table.byte_ids else [table.unknown]


def encode_word(word: str, table: Pieces) -> list[int]:
    """The fold in Python, for words that aren't in the lattice."""
    known, _ = _lookup(table)
    n = len(word)
    if not table.merges:
        worst = min((s for _, _, s in table.pieces), default=0.0) - UNKNOWN
        best: list[tuple[float, int]] = [(0.0, -1)] + [(float("inf"), -1)] * n
        for e in range(1, n + 1):
            for s in range(max(0, e - table.longest), e):
                score = known[word[s:e]][1] if word[s:e] in known else worst if e - s == 1 else None
                if score is not None:
                    best[e] = min(best[e], (best[s][0] - score, s))
        spans, e = [], n
        while e > 0:
            spans.append((best[e][1], e))
            e = best[e][1]
        spans.reverse()
    else:
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(s: int, m: int) -> None:
            if 0 <= s and m < n and (k := known.get(word[s : end[m]])):
                heapq.heappush(heap, (-k[1], s, m, end[m]))

        for s in range(n - 1):
            offer(s, s + 1)
        while heap:
            _, s, m, e = heapq.heappop(heap)
            if end[s] != m or end[m] != e:
                continue
            end[s], after[s], end[m] = e, after[m], -1
            if after[s] < n:
                before[after[s]] = s
            offer(s, after[s])
            offer(before[s], s)
        spans, s = [], 0
        while s < n:
            spans.append((s, end[s]))
            s = end[s]
    out: list[int] = []
    for s, e in spans:
        piece = known.get(word[s:e])
        out += [piece[0]] if piece else _unknown_ids(word[s:e], table)
    return out


class Decoder:
    """Texts of ids: the first blank, which encoding set, goes; bytes that are no UTF-8 become U+FFFD; ids
    of no piece give nothing."""

    def __init__(self, table: Pieces) -> None:
        _, by_id = _lookup(table)
        size = max(by_id, default=0) + 2
        parts = [by_id.get(i, b"") for i in range(size)]
        self.size = np.array([len(x) for x in parts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def __call__(self, ids: np.ndarray) -> str:
        ids = np.minimum(ids.astype(np.int64), len(self.size) - 1)
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return self.data[at].tobytes().decode("utf-8", "replace").replace(SPACE, " ").removeprefix(" ")


def decode_ids(ids: Iterable[int], table: Pieces) -> str:
    return Decoder(table)(np.array(list(ids), np.int64))


def lattice(words: DataFrame, table: Pieces, spark: SparkSession, keys: tuple[str, ...] = ("word",)) -> DataFrame:
    """``words`` (word, one row each, and columns that come along; dealt by some of ``keys``) with their edges. For tables of merges
    ``codes``: array of numbers in order of neg (the score's negative), then s, that hold neg's rank, s, e (places in
    the word) and id, in 32, 6, 6 and 20 bits; the first has no length, so that no word goes missing. Else ``edges``:
    array of struct neg, s, e, id; words without an edge go missing."""
    if len(table.pieces) > MOST_PIECES or max((i for _, i, _ in table.pieces), default=0) >= MOST_PIECES:
        raise ValueError(f"the piece table has over {MOST_PIECES} rows")
    rest = [c for c in words.columns if c not in keys]
    # of merges, an edge of no length too
    first, last = F.lit(0), F.least(F.col("s") + table.longest, F.length("word"))
    starts = words.select("*", F.explode(F.sequence(first, F.length("word") - 1)).alias("s"))
    from_ = F.when(F.col("s") == 0, 0).otherwise(F.col("s") + 1) if table.merges else F.col("s") + 1
    cut = starts.select("*", F.explode(F.sequence(from_, last)).alias("e")).withColumn("piece", F.substring("word", F.col("s") + 1, F.col("e") - F.col("s")))
    along = [F.first(c).alias(c) for c in rest]
    if table.merges:
        rank = {x: r + 1 for r, x in enumerate(sorted({-x for _, _, x in table.pieces}))}
        known = spark.createDataFrame([("", 0), *((p, rank[-x] << 32 | i) for p, i, x in table.pieces)], "piece string, code bigint")
        place = F.shiftleft(F.col("s").cast("bigint"), 26).bitwiseOR(F.shiftleft(F.col("e").cast("bigint"), 20))
        met = cut.join(F.broadcast(known), "piece").select(*keys, *rest, F.col("code").bitwiseOR(place).alias("code"))
        return met.groupBy(*keys).agg(*along, F.sort_array(F.collect_list("code")).alias("codes"))
    known = spark.createDataFrame(list(table.pieces), "piece string, id int, score double")
    edge = F.struct((-F.col("score")).alias("neg"), "s", "e", "id")
    return cut.join(F.broadcast(known), "piece").groupBy(*keys).agg(*along, F.array_sort(F.collect_list(edge)).alias("edges"))


def _byte_ids(char: Column, table: Pieces) -> Column:
    if not table.byte_ids:
        return F.array(F.lit(table.unknown))
    ids = F.split(F.lit(",".join(map(str, table.byte_ids))), ",").cast("array<int>")
    digits = F.hex(char.cast("binary"))
    return F.transform(F.sequence(F.lit(1), F.length(digits), F.lit(2)), lambda k: F.get(ids, F.conv(F.substring(digits, k, 2), 16, 10).cast("int")))


def _bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``x``, which is evaluated once."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), n.cast("int"))


def _merged(table: Pieces) -> Column:
    """ids of the columns word and codes. The places where a word is parted are bits; an edge joins two
    neighbours if both its ends and one place between them are set."""
    word, n = F.col("word"), F.length("word")

    def edge(c: Column) -> Column:
        s, e = (F.shiftright(c, k).bitwiseAND(F.lit(63)) for k in (26, 20))
        inner = F.when(e > s, _bit(e) - _bit(s + 1)).otherwise(F.lit(-1).cast("bigint"))
        return F.struct(_bit(s).bitwiseOR(_bit(e)).alias("ends"), inner.alias("inner"), s.cast("int").alias("s"), c.bitwiseAND(F.lit(MOST_PIECES - 1)).cast("int").alias("id"))

    # for the fold, all places of an edge and the two at its ends
    def join(d: Column) -> Column:
        return F.struct(d.inner.bitwiseOR(d.ends).alias("whole"), d.ends.alias("ends"))

    has = lambda bits, d: bits.bitwiseAND(d.ends) == d.ends

    def fold(joining: Column) -> Column:
        def step(bits: Column, _: Column) -> Column:
            joins = F.filter(joining, lambda d: (F.bit_count(bits.bitwiseAND(d.whole)) == 3) & has(bits, d))
            done = F.transform(F.slice(joins, 1, 1), lambda d: bits.bitwiseAND(F.bitwise_not(d.whole)).bitwiseOR(d.ends))
            # below 0 when nothing joins any more
            return F.when(bits < 0, bits).otherwise(F.coalesce(F.get(done, F.lit(0)), -bits))

        whole = _bit(n + 1) - 1
        return F.when((n > 1) & (F.size(joining) > 0), F.abs(F.aggregate(F.sequence(F.lit(1), n - 1), whole, step))).otherwise(whole)

    def told(edges: Column, bits: Column) -> Column:
        fits = F.filter(edges, lambda d: has(bits, d) & (bits.bitwiseAND(d.inner) == 0))
        own = F.array_sort(F.transform(fits, lambda d: F.struct(d.s.alias("s"), d.id.alias("id"))))

        def with_unknown(found: Column) -> Column:
            starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: bits.bitwiseAND(_bit(i)) != 0)
            ids = lambda i: F.transform(F.filter(found, lambda x: x.s == i), lambda x: x.id)
            return F.flatten(F.transform(starts, lambda i: F.when(F.exists(found, lambda x: x.s == i), ids(i)).otherwise(_byte_ids(F.substring(word, i + 1, F.lit(1)), table))))

        return _bound(own, lambda x: F.when(F.size(x) == F.bit_count(bits) - 1, F.transform(x, lambda d: d.id)).otherwise(with_unknown(x)))

    joining = lambda edges: F.transform(F.filter(edges, lambda d: d.inner > 0), join)
    return _bound(F.transform("codes", edge), lambda edges: _bound(_bound(joining(edges), fold), lambda bits: told(edges, bits)))


def folded(table: Pieces) -> Column:
    """ids (array of int) of the columns that ``lattice`` gives."""
    if table.merges:
        return _merged(table)
    word, edges, n = F.col("word"), F.col("edges"), F.length("word")
    worst = min((s for _, _, s in table.pieces), default=0.0) - UNKNOWN
    start = F.array(F.struct(F.lit(0.0).alias("total"), F.lit(-1).alias("s")))

    def reach(best: Column, e: Column) -> Column:
        own = F.transform(F.filter(edges, lambda d: d.e == e), lambda d: F.struct((F.get(best, d.s).total + d.neg).alias("total"), d.s.alias("s")))
        single = F.exists(edges, lambda d: (d.e == e) & (d.s == e - 1))
        alone = F.when(single, F.array().cast("array<struct<total:double,s:int>>")).otherwise(F.array(F.struct((F.get(best, e - 1).total - F.lit(worst)).alias("total"), (e - 1).alias("s"))))
        return F.concat(best, F.array(F.array_min(F.concat(own, alone))))

    best = F.aggregate(F.sequence(F.lit(1), n), start, reach)
    none = F.array().cast("array<struct<s:int,e:int>>")

    def back(a: Column, _: Column) -> Column:
        s = F.get(best, a.at).s
        return F.when(a.at > 0, F.struct(s.alias("at"), F.concat(F.array(F.struct(s.alias("s"), a.at.alias("e"))), a.spans).alias("spans"))).otherwise(a)

    spans = F.aggregate(F.sequence(F.lit(1), n), F.struct(n.alias("at"), none.alias("spans")), back, lambda a: a.spans)
    ids = lambda x: F.transform(F.filter(edges, lambda d: (d.s == x.s) & (d.e == x.e)), lambda d: d.id)
    return F.flatten(F.transform(spans, lambda x: F.when(F.size(ids(x)) > 0, F.slice(ids(x), 1, 1)).otherwise(_byte_ids(F.substring(word, x.s + 1, F.lit(1)), table))))


def _portioned(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches with the number of their portion, which the worker's partition and its rows decide."""
    number, held = 0, 0
    first = TaskContext.get().partitionId() << 20
    for b in portions(batches):
        if held + b.nbytes > PORTION and held:
            number, held = number + 1, 0
        held += b.nbytes
        yield first + number, b


def _packed(words: Iterable[bytes]) -> tuple[bytes, bytes]:
    """Lengths, in bytes each, and the words side by side."""
    words = list(words)
    return bytes(map(len, words)), b"".join(words)


def _mark(words: Iterable[bytes]) -> bytes:
    return hashlib.blake2b(b"\0".join(words), digest_size=8).digest()


def _by_bucket(words: Iterable[str], buckets: int) -> dict[int, list[bytes]]:
    """Words that the lattice takes, in order, by the bucket that their bytes decide."""
    out: dict[int, list[bytes]] = defaultdict(list)
    for w in words:
        if len(w) <= LONGEST:
            body = w.encode("utf-8", "surrogatepass")
            out[zlib.crc32(body) % buckets].append(body)
    return {k: sorted(own) for k, own in out.items()}


def encode(docs: DataFrame, table: Pieces, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``{key}``, n_words (long), ids (binary: little-endian 32-bit ids of the whole text), in the rows' number and
    order. Null and empty texts have no ids. Repeated rows and null keys are rows like any other."""
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{key}`").cast("bigint").alias("_key"), F.col(f"`{text}`").alias("_text"))
    path, buckets = fresh_path(spark, "words"), 4 * n_shuffle(spark)
    asked_schema = pa.schema([("bucket", pa.int32()), ("portion", pa.int64()), ("lengths", pa.binary()), ("words", pa.binary())])
    distinct_schema = pa.schema([("bucket", pa.int32()), ("word", pa.string()), ("portions", pa.binary())])
    told_schema = pa.schema([("portion", pa.int64()), ("bucket", pa.int32()), ("mark", pa.binary()), ("counts", pa.binary()), ("ids", pa.binary())])

    def by_portion(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
        now, held = None, []
        for number, b in _portioned(batches):
            if number != now and held:
                yield now, held
                held = []
            now = number
            held.append(b)
        if held:
            yield now, held

    def distinct_words(own: list[pa.RecordBatch]) -> set[str]:
        found: set[str] = set()
        for b in own:
            for x in b.column(1).to_pylist():
                found.update(words_of(x or ""))
        return found

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, own in by_portion(batches):
            rows = [(k, number, *_packed(words)) for k, words in _by_bucket(distinct_words(own), buckets).items()]
            if rows:
                yield batch(asked_schema, [*map(list, zip(*rows, strict=True))])

    def distinct(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, bytes], list[int]] = defaultdict(list)
        for b in batches:
            for k, number, lengths, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                at = 0
                for n in lengths:
                    known[k, words[at : at + n]].append(number)
                    at += n
        rows = [(k, w.decode("utf-8", "surrogatepass"), raw(np.array(of, np.int64))) for (k, w), of in known.items()]
        for at in range(0, len(rows), 10_000):
            yield batch(distinct_schema, [*map(list, zip(*rows[at : at + 10_000], strict=True))])

    def told(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple[bytes, bytes]]] = defaultdict(list)
        for b in batches:
            of = b.column(3)
            flat, ends = of.flatten().to_numpy().astype("<u4"), of.offsets.to_numpy() - of.offsets[0].as_py()
            for k, w, portions_, x, y in zip(*(b.column(i).to_pylist() for i in range(3)), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                entry = (w.encode("utf-8", "surrogatepass"), flat[x:y].tobytes())
                for number in np.frombuffer(portions_, np.int64).tolist():
                    held[number, k].append(entry)
        rows = []
        for (number, k), own in held.items():
            own.sort()
            ids = np.frombuffer(b"".join([x for _, x in own]), "<u4")
            rows.append((number, k, _mark(w for w, _ in own), raw(np.array([len(x) // 4 for _, x in own], np.uint16)), raw(ids.astype(small))))
        if rows:
            yield batch(told_schema, [*map(list, zip(*rows, strict=True))])

    small = "<u2" if max((i for _, i, _ in table.pieces), default=0) < 1 << 16 and max(table.byte_ids, default=0) < 1 << 16 > table.unknown else "<u4"
    asked = given.mapInArrow(lean(ask), "bucket int, portion bigint, lengths binary, words binary")
    words = asked.repartition(buckets, "bucket").mapInArrow(lean(distinct), "bucket int, word string, portions binary").repartition(buckets, "bucket")
    encoded = lattice(words, table, spark, ("bucket", "word")).select("bucket", "word", "portions", folded(table).alias("ids"))
    back = encoded.mapInArrow(lean(told), "portion bigint, bucket int, mark binary, counts binary, ids binary")
    limit = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(limit)
    try:
        # else edges are sorted after a few words; a task has its bucket's words in memory in any case
        spark.conf.set(limit, str(GROUPED))
        back.repartition("portion").sortWithinPartitions("portion").write.partitionBy("portion").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(limit, before)
    schema = pa.schema([("_key", pa.int64()), ("n_words", pa.int64()), ("ids", pa.binary())])

    def put_together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(path)
        for number, own in by_portion(batches):
            found = distinct_words(own)
            asked_for = _by_bucket(found, buckets)
            known = {w: np.array(encode_word(w, table), "<u4").astype(small).tobytes() for w in found if len(w) > LONGEST}
            if asked_for:
                if store.get_file_info(f"{top}/portion={number}").type != fs.FileType.Directory:
                    raise ValueError("a portion's words are not there: its texts were dealt out otherwise before")
                for part in ds.dataset(f"{top}/portion={number}", filesystem=store, format="parquet").to_batches(columns=["bucket", "mark", "counts", "ids"]):
                    for k, mark, counts, ids in zip(*(c.to_pylist() for c in part.columns), strict=True):
                        these = asked_for.pop(k, [])
                        if mark != _mark(these):
                            raise ValueError("a portion's words are others than before")
                        step = np.dtype(small).itemsize
                        ends = (np.cumsum(np.frombuffer(counts, np.uint16), dtype=np.int64) * step).tolist()
                        known.update(zip((w.decode("utf-8", "surrogatepass") for w in these), (ids[x:y] for x, y in zip([0, *ends[:-1]], ends, strict=True)), strict=True))
            if asked_for:
                raise ValueError("some of a portion's words are not there")
            del found
            for b in own:
                n, out = [], []
                for x in b.column(1).to_pylist():
                    words = words_of(x or "")
                    n.append(len(words))
                    out.append(np.frombuffer(b"".join(map(known.__getitem__, words)), small).astype("<u4").tobytes())
                yield batch(schema, [b.column(0), n, out])

    kind = docs.schema[key].dataType.simpleString()
    made = given.mapInArrow(lean(put_together), "_key bigint, n_words bigint, ids binary")
    return made.select(F.col("_key").cast(kind).alias(key), "n_words", "ids")


def decode(encoded: DataFrame, table: Pieces, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the text of its ids; null ids give null."""
    columns = encoded.columns
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = Decoder(table)
        for b in portions(batches):
            texts = [None if x is None else text_of(np.frombuffer(x, "<u4")) for x in b.column(columns.index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*columns, "decoded"])

    return encoded.mapInArrow(lean(work), schema)


def public_table() -> Pieces:
    return Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    back = decode(encode(docs, public_table()), public_table())
    return back.select(
        "doc_id", "n_words", (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32")
    )


QUERIES = {"op6_sentence_pieces": op6_sentence_pieces}
ORACLE_SQL: dict[str, str] = {}
