"""WARC: writing page captures as archives, reading records back, and assembling transactions.

A capture is a response (or a revisit), its request and its metadata, each a record of its own.
Requests and metadata name the response in WARC-Concurrent-To; ``assemble`` joins them by it and
gives one nested row per capture.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintgraph.llm.shared import batch, fresh_path, written

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A worker begins another archive after so many bytes.
ARCHIVE_BYTES = 64 << 20
#: How hard records are compressed, of 9.
LEVEL = 3
CAPTURES = ("response", "revisit", "resource")
_CHUNK = 1 << 16


def _record_id(kind: str, page_id: int | None, digest: str, again: str | None = None) -> str:
    """``again`` tells rows apart that repeat an id with an equal payload; one of them has none."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, ':'.join([kind, str(page_id), digest, *([again] if again else [])])).urn}>"


def _base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _safe(value: str) -> str:
    """A header's value: what can't stand in a line is escaped as in a URL."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value)


def _record(kind: str, record_id: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = {"WARC-Type": kind, "WARC-Record-ID": record_id, "WARC-Date": DATE} | headers | {"Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()) + "\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``_id, _url, _html, _sha1, _refers, _again``: of rows with equal payloads of ``least`` bytes or more,
    those with the largest id (nulls are smallest) are responses, the others refer to that id. Of rows
    that repeat both id and payload all but one have a token of their own, ``_again``."""
    keyed = pages.withColumn("_sha1", F.sha1(F.coalesce("_html", F.lit("")).cast("binary")))
    counts = keyed.select("_id", "_sha1", F.coalesce(F.octet_length("_html"), F.lit(0)).alias("_bytes")).groupBy("_id", "_sha1", "_bytes").agg(F.count(F.lit(1)).alias("_times"))
    last = F.when(F.col("_bytes") >= least, F.max("_id")).alias("_last")
    groups = counts.groupBy("_sha1", "_bytes").agg(last, F.sum("_times").alias("_n"), F.max("_times").alias("_most")).where("_n > 1")
    groups = written(groups.select("_sha1", "_last", "_most"), "payload-groups")
    refers = F.when(~F.col("_id").eqNullSafe(F.col("_last")), F.col("_last"))
    # payloads are as many as pages, whatever their compressed size: never broadcast
    met = keyed.join(groups.hint("merge"), "_sha1", "left").withColumn("_refers", refers)
    columns = ["_id", "_url", "_html", "_sha1", "_refers"]
    if groups.where("_most > 1").isEmpty():
        return met.select(*columns, F.lit(None).cast("string").alias("_again"))
    odd = written(met.where("_most > 1").select(*columns, F.uuid().alias("_token")), "repeated-pages")
    first = written(odd.select(F.struct("_id").alias("_of"), "_sha1", "_token").groupBy("_of", "_sha1").agg(F.min("_token").alias("_first")), "first-pages")
    told = odd.withColumn("_of", F.struct("_id")).join(first.hint("merge"), ["_of", "_sha1"])
    again = told.select(*columns, F.when(F.col("_token") != F.col("_first"), F.col("_token")).alias("_again"))
    return met.where("_most is null or _most = 1").select(*columns, F.lit(None).cast("string").alias("_again")).unionByName(again)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Writes three records per row of ``pages`` to gzipped archives under ``path`` and returns the
    list of archives (archive, records, bytes). Only archives in the list count: what a lost or
    repeated task leaves behind isn't in it.

    A null html is an empty payload, a null URL leaves out the target. Rows that repeat one another give
    records of their own, with ids of their own. Extra columns aren't written.
    """
    given = with_revisits(pages.select(F.col(f"`{key}`").cast("bigint").alias("_id"), F.col(f"`{url}`").alias("_url"), F.col(f"`{html}`").alias("_html")), least)
    schema = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(path)
        store.create_dir(top, recursive=True)
        out, name, n, size = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for b in batches:
            for page_id, url, html, sha1, refers, again in zip(*(b.column(i) for i in range(6)), strict=True):
                if out is None:
                    name, n, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                for r in transaction(page_id.as_py(), url.as_py(), html.as_py() or "", sha1.as_py(), refers.as_py(), again.as_py()):
                    out.write(r)
                    n, size = n + 1, size + len(r)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done, out = [*done, (name, n, size)], None
        if out is not None:
            out.close()
            done.append((name, n, size))
        yield batch(schema, [*map(list, zip(*done, strict=True))] if done else [[], [], []])

    columns = given.select("_id", "_url", "_html", "_sha1", "_refers", "_again")
    return written(columns.mapInArrow(work, "archive string, records bigint, bytes bigint"), "archives")


def _request(url: str | None) -> bytes:
    """The request that a URL stands for: its path and query, and its host."""
    m = re.match("(?:[^:/?#]*://([^/?#]*))?([^#]*)", _safe(url or ""))
    target, host = f"/{m[2].removeprefix('/')}", f"Host: {m[1]}\r\n" if m[1] else ""
    return f"GET {target} HTTP/1.1\r\n{host}\r\n".encode()


def transaction(page_id: int | None, url: str | None, html: str, sha1: str, refers: int | None, again: str | None = None) -> list[bytes]:
    """The records of a capture: response or revisit, request, metadata."""
    payload, digest = html.encode("utf-8", "surrogatepass"), _base32(sha1)
    own = _record_id("capture", page_id, digest, again)
    target = {"WARC-Target-URI": _safe(url)} if url is not None else {}
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = target | {"WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response"}
    if refers is None:
        first = _record("response", own, common, head + payload)
    else:
        first = _record("revisit", own, common | {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_id("capture", refers, digest)}, head)
    beside = target | {"WARC-Concurrent-To": own}
    request = _record("request", _record_id("request", page_id, digest, again), beside | {"Content-Type": "application/http; msgtype=request"}, _request(url))
    fields = f"page_id: {page_id}\r\n".encode() if page_id is not None else b""
    return [first, request, _record("metadata", _record_id("metadata", page_id, digest, again), beside | {"Content-Type": "application/warc-fields"}, fields)]


def _unzipped(source: pa.NativeFile) -> Iterator[bytes]:
    """Of a stream of gzip members, or of a plain one."""
    head = source.read(_CHUNK)
    if head[:2] != b"\x1f\x8b":
        while head:
            yield head
            head = source.read(_CHUNK)
        return
    member = zlib.decompressobj(31)
    while head:
        yield member.decompress(head)
        head = member.unused_data
        if member.eof:
            member = zlib.decompressobj(31)
        head = head or source.read(_CHUNK)


def parse(source: pa.NativeFile) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Headers (names in lower case, each with all its values) and block of every record."""
    held, parts = bytearray(), _unzipped(source)

    def fill(n: int) -> bool:
        while len(held) < n:
            part = next(parts, None)
            if part is None:
                return False
            held.extend(part)
        return True

    while True:
        while fill(1) and held[:1] in (b"\r", b"\n"):
            del held[:1]
        if not held:
            return
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not fill(len(held) + 1):
                raise ValueError("an archive ends within a record's headers")
        version, *lines = bytes(held[:end]).decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("an archive has something other than records")
        headers: dict[str, list[str]] = {}
        for name, _, value in (x.partition(":") for x in lines):
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers.get("content-length", ["0"])[0])
        if not fill(end + 4 + size):
            raise ValueError("an archive ends within a record")
        block = bytes(held[end + 4 : end + 4 + size])
        del held[: end + 4 + size]
        yield headers, block


def read_archives(archives: DataFrame, path: str, payloads: bool = False) -> DataFrame:
    """One row per record: archive, record_id, type, target, date, concurrent_to (array), refers_to,
    status (int), payload_bytes, payload_digest (of the full payload: computed for responses, as
    stated for revisits), fields (of metadata: array of name, value), payload (binary, null unless ``payloads``)."""
    names = "archive record_id type target date concurrent_to refers_to status payload_bytes payload_digest fields payload".split()
    kinds = [pa.string()] * 5 + [pa.list_(pa.string()), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())])), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(path)
        rows: list[tuple] = []
        held = 0
        for name in (x for b in batches for x in b.column(0).to_pylist()):
            with store.open_input_stream(f"{top}/{name}", compression=None) as source:
                for headers, block in parse(source):
                    rows.append((name, *described(headers, block, payloads)))
                    held += len(rows[-1][-1] or b"")
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield batch(schema, [*map(list, zip(*rows, strict=True))])
                        rows, held = [], 0
        if rows:
            yield batch(schema, [*map(list, zip(*rows, strict=True))])

    spread = archives.select("archive").repartition(max(1, archives.count()), "archive")
    return spread.mapInArrow(work, "archive string, record_id string, type string, target string, date string, concurrent_to array<string>, refers_to string, status int, payload_bytes bigint, payload_digest string, fields array<struct<name:string,value:string>>, payload binary")


def described(headers: dict[str, list[str]], block: bytes, payloads: bool) -> tuple:
    one = lambda k: headers.get(k, [None])[0]
    kind, status, n, digest, fields, payload = one("warc-type"), None, None, None, None, None
    if kind in CAPTURES:
        head, body = b"", block
        if (one("content-type") or "").startswith("application/http"):
            head, _, body = block.partition(b"\r\n\r\n")
            first, *lines = head.decode("latin-1").split("\r\n")
            status = int(first.split(" ")[1]) if first.split(" ")[1:2] and first.split(" ")[1].isdigit() else None
        if kind == "revisit":
            stated = [x.split(":")[1].strip() for x in head.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")]
            n, digest = int(stated[0]) if stated else None, (one("warc-payload-digest") or "").removeprefix("sha1:") or None
        else:
            n, digest, payload = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), body if payloads else None
    elif kind == "metadata":
        fields = [dict(zip(("name", "value"), map(str.strip, x.split(":", 1)), strict=True)) for x in block.decode("utf-8", "replace").split("\r\n") if ":" in x]
    return one("warc-record-id"), kind, one("warc-target-uri"), one("warc-date"), headers.get("warc-concurrent-to", []), one("warc-refers-to"), status, n, digest, fields, payload


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture (its response, revisit or resource), requests and metadata
    (arrays of records, in order of their ids, empty where there are none). A record stands beside a
    capture if either names the other in WARC-Concurrent-To. Records of the same id count once; a
    request or metadata record that belongs to no capture is in no row."""
    slim = ["record_id", *(c for c in records.columns if c not in ("record_id", "payload"))]
    captures = records.where(F.col("type").isin(*CAPTURES)).dropDuplicates(["record_id"])
    others = records.where(F.col("type").isin("request", "metadata")).select(*slim)
    named = others.select(F.explode("concurrent_to").alias("_of"), F.struct(*slim).alias("_r"))
    naming = captures.select(F.col("record_id").alias("_of"), F.explode("concurrent_to").alias("_id"))
    # no side of these joins is bounded, and archives are small beside what is in them: never broadcast
    naming = naming.join(others.select(F.col("record_id").alias("_id"), F.struct(*slim).alias("_r")).hint("merge"), "_id").select("_of", "_r")
    beside = named.unionByName(naming).withColumn("_k", F.col("_r.record_id")).dropDuplicates(["_of", "_k"])
    kind = lambda t: F.array_sort(F.collect_list(F.when(F.col("_r.type") == t, F.col("_r"))))
    groups = beside.groupBy("_of").agg(kind("request").alias("requests"), kind("metadata").alias("metadata"))
    rows = captures.select(F.struct(*captures.columns).alias("capture")).join(groups.hint("merge"), F.col("capture.record_id") == F.col("_of"), "left")
    none = lambda c: F.coalesce(c, F.array().cast(groups.schema[c].dataType)).alias(c)
    return rows.select("capture", none("requests"), none("metadata"))


def op2_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = fresh_path(spark, "warc")
    # written, so that captures and what stands beside them come from one reading of the archives
    records = written(read_archives(write_archives(pages, path), path).drop("payload"), "records")
    captures = assemble(records)
    fields = F.filter(F.flatten("metadata.fields"), lambda x: x["name"] == "page_id")
    page = F.get(fields, 0)["value"].cast("bigint").alias("page_id")
    flat = written(captures.select(page, *(f"capture.{x}" for x in ("record_id", "type", "payload_bytes", "payload_digest", "refers_to"))), "captures")
    known = flat.where("type <> 'revisit'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("_refers"))
    return flat.join(known.hint("merge"), "refers_to", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("_refers").alias("refers_to")
    )


QUERIES = {"op2_warc_transactions": op2_warc_transactions}
ORACLE_SQL: dict[str, str] = {
    "op2_warc_transactions": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
b AS (SELECT page_id, strlen(html) AS n, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS last,
  array_to_string(list_transform(range(1, 41), lambda i: right('000' || bin(instr('0123456789abcdef', substr(sha1(html), CAST(i AS INTEGER), 1)) - 1), 4)), '') AS bits FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, CAST(5 * i + j + 1 AS INTEGER), 1) AS INTEGER) * CAST(pow(2, 4 - j) AS INTEGER))) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to FROM b"""
}
