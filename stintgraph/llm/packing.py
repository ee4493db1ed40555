"""Packing: harmonic packing of tokenized documents into sequences of fixed length.

Each worker packs what it reads, on its own. A document fills whole sequences as long as it can; the
rest is classed by its true length: class k holds lengths with capacity / (k + 1) < length <=
capacity / k, and k pieces of class k make a sequence. What such a sequence lacks is cut from the
front of one more rest, the donor, and from the next one where that ends; so no sequence is padded
but the last of each worker, where what is left of all classes is laid side by side.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stintgraph.llm.shared import batch, lean, portions

CAPACITY = 1024
#: A worker remembers the ids of so many words, and of as many before them (some 150 bytes each).
REMEMBERED = 500_000
#: Ids kept in memory before rows are handed on.
FLUSH_IDS = 1 << 20

#: How the public byte-level vocabulary parts a text, spelled out for U+0000 to U+00FF.
LETTERS, DIGITS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\\t\\n\\x0b\\x0c\\r \x85\xa0"
WORDS = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{SPACES}{LETTERS}{DIGITS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
PLAIN = re.compile("[\x00-\xff]*\\Z")


class Words(dict):
    """Ids by word, made when first asked for. What wasn't asked for again in the time of REMEMBERED other words goes."""

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.encode, self.before = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            own = self.encode(word)
            ids = struct.pack(f"<{len(own)}I", *own)
        self[word] = ids
        return ids

    def age(self) -> None:
        if len(self) > REMEMBERED:
            self.before = dict(self)
            self.clear()


class ByteBpe:
    """Ids of a text under a byte-level BPE vocabulary, as little-endian 32-bit bytes, by the tokenizer. Texts
    within U+0000 to U+00FF are parted into words first, which a bounded memory knows again; all others
    go to the tokenizer as a whole. Both give the same ids. Names of special tokens are ordinary text."""

    def __init__(self, vocabulary: str) -> None:
        self.whole = Tokenizer.from_file(vocabulary)
        self.whole.encode_special_tokens = True
        self.known = Words(lambda word: self.whole.encode(word, add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        if not PLAIN.match(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self.known.age()
        return b"".join(map(self.known.__getitem__, WORDS.findall(text)))


@lru_cache(1)
def tokenizer(vocabulary: str) -> ByteBpe:
    return ByteBpe(vocabulary)


def cuts(length: int, capacity: int) -> Iterator[int]:
    """Lengths of what a document of ``length`` ids gives: whole sequences, then the rest."""
    yield from [capacity] * (length // capacity)
    if length % capacity:
        yield length % capacity


class Bins:
    """Open sequences of one worker: for each class k fewer than k pieces, one sequence that waits to be
    filled up, and the donor. Pieces are lists of key, start, length, ids and the document's length."""

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.next_id, self.open = capacity, first_id, {}
        self.waiting: list[list] = []
        self.lack, self.donor = 0, None

    def put(self, piece: list) -> list[tuple[int, int, list]]:
        """Placements (sequence_id, offset, piece) of a sequence that ``piece`` completes."""
        if piece[2] == self.capacity:
            return self._close([piece])
        if self.waiting:
            self.donor = piece
            return self._fill()
        k = self.capacity // piece[2]
        own = self.open.setdefault(k, [])
        own.append(piece)
        if len(own) < k:
            return []
        del self.open[k]
        self.waiting, self.lack = own, self.capacity - sum(p[2] for p in own)
        return self._fill()

    def _fill(self) -> list[tuple[int, int, list]]:
        if self.lack and self.donor:
            head, self.donor = self._parted(self.donor, self.lack)
            self.waiting.append(head)
            self.lack -= head[2]
        if self.lack:
            return []
        own, self.waiting = self.waiting, []
        return self._close(own)

    @staticmethod
    def _parted(piece: list, n: int) -> tuple[list, list | None]:
        """The first ``n`` ids of a piece, and what is left of it."""
        key, start, length, ids, total = piece
        if length <= n:
            return piece, None
        return [key, start, n, ids[: 4 * n], total], [key, start + n, length - n, ids[4 * n :], total]

    def rest(self) -> Iterator[tuple[int, int, list]]:
        """All that is still open, side by side, the largest classes first."""
        left = [*self.waiting, *([self.donor] if self.donor else []), *(p for k in sorted(self.open) for p in self.open[k])]
        self.open, self.waiting, self.donor = {}, [], None
        own, room = [], self.capacity
        for p in left:
            while p:
                head, p = self._parted(p, room)
                own.append(head)
                room -= head[2]
                if not room:
                    yield from self._close(own)
                    own, room = [], self.capacity
        if own:
            yield from self._close(own)

    def _close(self, own: list) -> list[tuple[int, int, list]]:
        out, offset, sid = [], 0, self.next_id
        self.next_id += 1
        for p in own:
            out.append((sid, offset, p))
            offset += p[2]
        return out


def pack(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """One row per piece of a document: ``{key}``, start, length (long), ids (binary: little-endian
    32-bit ids), doc_tokens, sequence_id, offset (long). The ids of a document are those of its text
    and ``end_id`` behind them, so a null or empty text is one piece of one id. Pieces of a sequence lie
    side by side from offset 0; together they have at most ``capacity`` ids. Sequence ids are unique.

    Repeated rows and null keys are documents like any other. A worker holds fewer than k pieces of
    class k, a sequence and a donor, whatever it reads; a text is tokenized as a whole, in memory.
    """
    if not 1 <= capacity < 1 << 20:
        raise ValueError("capacity must be at least 1 and under 2**20")
    schema = pa.schema([("_key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = tokenizer(vocabulary), Bins(capacity, TaskContext.get().partitionId() << 40)
        done: list[tuple[int, int, list]] = []
        held = 0

        def rows() -> pa.RecordBatch:
            return batch(schema, [[x[2][0] for x in done], [x[2][1] for x in done], [x[2][2] for x in done], [x[2][3] for x in done], [x[2][4] for x in done], [x[0] for x in done], [x[1] for x in done]])

        for b in portions(batches):
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(body.as_py() or "") + end
                total, start = len(ids) // 4, 0
                for n in cuts(total, capacity):
                    placed = bins.put([doc_id, start, n, ids[4 * start : 4 * (start + n)], total])
                    held += sum(x[2][2] for x in placed)
                    done += placed
                    start += n
                if held >= FLUSH_IDS:
                    yield rows()
                    done.clear()
                    held = 0
        done += bins.rest()
        if done:
            yield rows()

    kind = docs.schema[key].dataType.simpleString()
    given = docs.select(F.col(f"`{key}`").cast("bigint").alias("_key"), F.col(f"`{text}`").alias("_text"))
    packed = given.mapInArrow(lean(work), "_key bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")
    return packed.select(F.col("_key").cast(kind).alias(key), *packed.columns[1:])


def public_paths() -> tuple[str]:
    return (public_tokenizers.path("byte_bpe_50k.json"),)


def with_crc(packed: DataFrame) -> DataFrame:
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_crc(pack(docs, *public_paths())).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES = {"op3_harmonic_packing": op3_harmonic_packing}
ORACLE_SQL: dict[str, str] = {}
