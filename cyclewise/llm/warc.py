"""WARC archives: a writer with revisit records and a reader that salvages damage.

Writing. Every record is one gzip member (or plain text), so a damaged member costs one
record. Spark's text writer stores the members: its line separator is the NUL that ends
each member, as the last byte of a member is the high byte of a length; a record of
16 MiB or more gets an empty member behind it, which ends with NUL too. Files are written
by Spark to any file system; a task closes an archive by its bytes (``BYTES_PER_FILE``).

Equal payloads are stored once. The winner of a payload is found by two aggregates, per
digest and salt, then per digest, and comes back by a join on digest and salt, so a
payload that a third of the pages share is spread over as many tasks as there are salts.

Reading. A file is one row of the ``binaryFile`` source. The reader walks over members (or
plain records). If a check fails (member does not inflate, CRC, version line, header,
length, payload digest), the bytes are quarantined and the reader searches for the next
byte from which a member or a version line reads well, so later records are recovered.
Gaps are rows of the result with ``kind = 'gap'``, offset, length and reason.

Defined results: null html is an empty payload; an empty payload is a payload like any
other; null page ids never win against others, and rows with the same largest page id
are all responses; an empty table writes nothing and reads as an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclewise.llm.common import partitions_of, prepare, scratch

#: An archive is closed behind the record that brings it to so many bytes, or so many records.
BYTES_PER_FILE = 256 * 1024 * 1024
RECORDS_PER_FILE = 5_000
#: Payloads of at least so many bytes may become revisit records.
REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = b"WARC/1."
VERSION_LINE = re.compile(rb"WARC/1\.[0-9]\r\n")
MAGIC = b"\x1f\x8b\x08"
HEADER_END = b"\r\n\r\n"
EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()

RECORD_SCHEMA = (
    "kind string, path string, offset long, length long, reason string, page_id long, url string, "
    "record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_bytes(page_id, url, payload: bytes, refers_to, revisit: bool, digest: str) -> bytes:
    """One WARC record as plain bytes, with the two line ends behind it."""
    name = "null" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {0 if revisit else len(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + (b"" if revisit else payload) + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member without its last byte, which is NUL."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    packed = packer.compress(data) + packer.flush()
    return (packed if packed[-1] == 0 else packed + EMPTY_MEMBER)[:-1]


def with_winners(pages: DataFrame, salts: int, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages with payload, its SHA-1 and ``winner``, the page id that stores the payload."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {
            "sha": F.unhex(F.sha1("payload")),
            "salt": F.pmod(F.xxhash64("page_id"), F.lit(salts)),
        }
    )
    narrow = hashed.select("sha", "salt", "page_id")
    salted = narrow.groupBy("sha", "salt").agg(F.max("page_id").alias("top"))
    best = salted.groupBy("sha").agg(F.max("top").alias("winner"), F.collect_list("salt").alias("salt"))
    best = best.select("sha", "winner", F.explode("salt").alias("salt"))
    joined = hashed.join(best, ["sha", "salt"])
    own = (F.length("payload") < revisit_bytes) | F.col("winner").isNull()
    return joined.withColumn("winner", F.when(own, F.col("page_id")).otherwise(F.col("winner")))


def _pack(batches: Iterator[pa.RecordBatch], compress: bool, limit: int) -> Iterator[pa.RecordBatch]:
    archive, records, size = 0, 0, 0
    for batch in batches:
        out, places = [], []
        columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha", "winner"))
        for page_id, url, payload, sha, winner in zip(*columns):
            revisit = winner is not None and page_id != winner
            data = record_bytes(page_id, url, payload, winner, revisit, _base32(sha))
            out.append(member(data) if compress else data[:-1])
            places.append(archive)
            records, size = records + 1, size + len(out[-1]) + 1
            if size >= limit or records >= RECORDS_PER_FILE:
                archive, records, size = archive + 1, 0, 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(places, pa.int32())], ["value", "archive"])


def write_warc(
    pages: DataFrame,
    path: str,
    compress: bool = True,
    revisit_bytes: int = REVISIT_BYTES,
    bytes_per_file: int = BYTES_PER_FILE,
) -> None:
    """Write a record per row of ``page_id, url, html`` to archives in ``path``.

    A task starts a new archive by bytes; a reader takes an archive as one value, so its
    size is bounded, but for a single record that is longer by itself.
    """
    spark = prepare(pages.sparkSession)
    chosen = with_winners(pages, partitions_of(spark), revisit_bytes)
    packed = chosen.mapInArrow(lambda batches: _pack(batches, compress, bytes_per_file), "value binary, archive int")
    (
        packed.select(F.col("value").cast("string"), "archive")
        .write.partitionBy("archive")
        .option("lineSep", "\u0000" if compress else "\n")
        .text(path)
    )


class _Bad(Exception):
    """A check failed; the text is the reason."""


def _parse_plain(data: bytes, at: int, stop: int) -> tuple[int, dict[str, str], bytes]:
    """Record at ``at``: end, header fields, block. ``stop`` is the next empty line, -1 if there is none."""
    if not VERSION_LINE.match(data, at):
        raise _Bad("no version line")
    if stop < 0:
        raise _Bad("header does not end")
    head = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head)}
    if not re.fullmatch(r"\d{1,15}", fields.get("content-length", "")):
        raise _Bad("no content length")
    begin, size = stop + 4, int(fields["content-length"])
    end = begin + size
    if data[end : end + 4] != b"\r\n\r\n":
        raise _Bad("record does not end where its length says")
    block = data[begin:end]
    digest = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "response" and digest.startswith("sha1:"):
        if _base32(hashlib.sha1(block).digest()) != digest[5:]:
            raise _Bad("payload digest differs")
    return end + 4, fields, block


def read_records(data: bytes) -> Iterator[tuple]:
    """Records ``("record", offset, length, fields, block)`` and gaps ``("gap", offset, length, reason)``."""
    at, gap, reason, size = 0, None, "", len(data)
    ahead = {MAGIC: -1, VERSION: -1}
    stop = data.find(HEADER_END)  # searched anew only behind it, so marks without a header cost nothing
    while at < size:
        packed = data.startswith(MAGIC, at)
        if 0 <= stop < at:
            stop = data.find(HEADER_END, at)
        try:
            if packed:
                end, fields, block = _parse_member(data, at)
            else:
                end, fields, block = _parse_plain(data, at, stop)
        except _Bad as bad:
            if gap is None:
                gap, reason = at, str(bad)
            for mark, place in ahead.items():
                if place <= at:
                    found = data.find(mark, at + 1)
                    ahead[mark] = found if found >= 0 else size
            at = min(ahead.values())
            continue
        if gap is not None:
            yield "gap", gap, at - gap, reason
            gap = None
        if fields:
            yield "record", at, end - at, fields, block
        at = end
    if gap is not None:
        yield "gap", gap, size - gap, reason


def _parse_member(data: bytes, at: int) -> tuple[int, dict[str, str], bytes]:
    """Record in the gzip member at ``at``, inflated from growing windows; no fields if it is empty."""
    unpacker, parts, pos, window = zlib.decompressobj(31), [], at, 1 << 14
    try:
        while not unpacker.eof and pos < len(data):
            parts.append(unpacker.decompress(data[pos : pos + window]))
            pos += window
            window *= 2
    except zlib.error as error:
        raise _Bad("member does not inflate") from error
    if not unpacker.eof:
        raise _Bad("member is cut off")
    end = min(pos, len(data)) - len(unpacker.unused_data)
    plain = b"".join(parts)
    if not plain:
        return end, {}, b""
    stop, fields, block = _parse_plain(plain, 0, plain.find(HEADER_END))
    if stop != len(plain):
        raise _Bad("more than one record in a member")
    return end, fields, block


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _unpack(batches: Iterator[pa.RecordBatch], schema: pa.Schema, keep_payload: bool) -> Iterator[pa.RecordBatch]:
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema
        )

    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
            rows, held = [], 0
            for kind, offset, length, *rest in read_records(data):
                if kind == "gap":
                    rows.append((kind, path, offset, length, rest[0], *[None] * 7))
                else:
                    fields, block = rest
                    revisit = fields.get("warc-type") == "revisit"
                    stated = fields.get("x-payload-length", "")
                    n = int(stated) if revisit and stated.isdigit() else len(block)
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    rows.append(
                        (kind, path, offset, length, None, _page(fields.get("warc-record-id")),
                         fields.get("warc-target-uri"), fields.get("warc-type"),
                         _page(fields.get("warc-refers-to")) if revisit else None, n, digest or None,
                         block if keep_payload and not revisit else None)
                    )
                    held += len(block)
                if len(rows) >= 2_000 or held > 8_000_000:
                    yield flush(rows)
                    rows, held = [], 0
            if rows:
                yield flush(rows)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of all archives in ``path``."""
    fields = [f.strip().split(" ") for f in RECORD_SCHEMA.split(",")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])
    files = prepare(spark).read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.select("path", "content")
    return files.mapInArrow(lambda batches: _unpack(batches, schema, payload), RECORD_SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the records back, payloads left out."""
    path = scratch(pages.sparkSession, "warc")
    write_warc(pages, path)
    records = read_warc(pages.sparkSession, path, payload=False)
    gap = F.concat(F.lit("gap in an archive that was just written: "), "path", F.lit(" "), "reason")
    whole = F.when(F.col("kind") == "record", F.col("payload_bytes")).otherwise(F.raise_error(gap).cast("long"))
    return records.select("page_id", whole.alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
