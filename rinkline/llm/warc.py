"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

The dictionary is trained on a bounded sample of the records and lies in a
skippable frame at the head of every archive, so an archive can be read alone.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkline.llm._shared import discard, if_small, new_path, stored, with_groups

#: Magic number of the skippable frame that holds the dictionary, as the WARC-Zstandard format gives it (fixed value).
DICTIONARY_FRAME = 0x184D2A5D
#: Pages that the dictionary is trained on, characters of each, its size, and the bytes at which a new archive begins.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES, ARCHIVE_BYTES = 400, 32_768, 64 << 10, 256 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, archive string, position long, length long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(url: str | None) -> str:
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record, not compressed."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url)}", "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record as a row of RECORDS. Raises ValueError if the payload does not have its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    kind, name = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != name):
        raise ValueError(f"record {fields['WARC-Record-ID']} does not hold its payload")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": name,
        "record_type": kind, "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
    }


def _write(batches: Iterator[pa.RecordBatch], folder: str, dictionary: bytes, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, refers_to) batches to archives; yields index rows. Every attempt has files of its own."""
    import zstandard
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=3)
    out, name, at = None, "", 0
    try:
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out = store.open_output_stream(f"{root}/{name}")
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                    at = 8 + len(dictionary)
                frame = packer.compress(record(page_id, url, (html or "").encode("utf-8"), refers_to, refers_to is not None and refers_to != page_id))
                out.write(frame)
                rows.append((page_id, name, at, len(frame)))
                at += len(frame)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["page_id", "archive", "position", "length"])
    finally:
        if out is not None:
            out.close()


def archive_records(store, path: str) -> Iterator[dict]:
    """The records of one archive, read from its head with the dictionary it brings."""
    import zstandard

    with store.open_input_stream(path) as stream:
        magic, size = struct.unpack("<II", stream.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path} does not begin with a dictionary")
        dictionary = stream.read(size)
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if size else zstandard.ZstdDecompressor()
        rest = b""
        frame, parts = unpacker.decompressobj(), []
        while rest or (rest := stream.read(1 << 20)):
            parts.append(frame.decompress(rest))
            rest = b""
            if frame.eof:
                yield parse(b"".join(parts))
                rest = frame.unused_data
                frame, parts = unpacker.decompressobj(), []


def _read(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}
    rows: list[dict] = []
    size = 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], list(kinds))

    for batch in batches:
        for name in batch.column(0).to_pylist():
            for row in archive_records(store, f"{root}/{name}"):
                if not payloads:
                    row["payload"] = None
                rows.append(row)
                size += len(row["payload"] or b"") + 100
                if size > 4 << 20:
                    yield flush()
                    rows, size = [], 0
    if rows:
        yield flush()


def train_dictionary(pages: DataFrame, sample: int = SAMPLE_PAGES, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the records of about `sample` pages, chosen by a hash of the row; no bytes if they are too few.

    At most twice as many rows, and of each at most SAMPLE_CHARS characters, go to the driver.
    """
    import zstandard

    draw = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(1 << 30)) / float(1 << 30)
    drawn = pages.where(draw < min(1.0, sample / max(1, pages.count()))).withColumn("html", F.substring("html", 1, SAMPLE_CHARS))
    chosen = sorted(drawn.limit(2 * sample).collect(), key=repr)
    samples = [record(r.page_id, r.url, (r.html or "").encode("utf-8"), None, False) for r in chosen]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little in the samples to learn from
        return b""


def write_archives(pages: DataFrame, folder: str, revisit_from: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes pages (page_id, url, html) as WARC archives into folder; returns their index, one row per page: INDEX.

    Of pages with equal payloads of at least revisit_from bytes, that with the
    largest page_id is a response and the others revisit it; smaller payloads
    are all responses.  Index rows name the archives that count: a repeated
    task leaves files behind that no row names.

    * Null html is an empty payload; empty payloads are equal.
    * A page_id may repeat with other payloads; each row is told by page_id and payload.
    * Rows that repeat the largest page_id of a payload are all responses.
      A page without an id revisits the largest page_id of its payload; where
      no page of a payload has an id there is nothing to refer to, and all are responses.
    * Control characters and white space in URLs are percent-encoded; null URLs are empty.
    * An empty table writes nothing; further columns are ignored.

    Spark: payloads are hashed in the scan and grouped by hash with map-side
    aggregation; groups come back to their rows without gathering a large one
    in a task.  Up to BROADCAST_ROWS revisits, narrow rows, are broadcast and
    pages are written where they are read; beyond, pages are shuffled once.
    """
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    hashed = pages.withColumns({"size": F.octet_length(payload), "sha1": F.sha1(payload), "extra": F.xxhash64(payload)})
    payloads = stored(hashed.select("page_id", "size", "sha1", "extra"), "payloads")
    rows = payloads.where(F.col("size") >= revisit_from)
    key = ["size", "sha1", "extra"]
    twice = rows.groupBy(*key).agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = stored(twice, "payload_groups")
    others = with_groups(rows, twice, key, "n").where("refers_to is not null and not (page_id <=> refers_to)")
    own = [F.col("page_id").isNull().alias("unnamed"), F.coalesce("page_id", F.lit(0).cast("long")).alias("page")]
    revisits = stored(others.select(*own, *key, "refers_to").distinct(), "revisits")
    marked = hashed.select("*", *own).join(if_small(revisits), ["unnamed", "page", *key], "left").select("page_id", "url", "html", "refers_to")
    write = partial(_write, folder=folder, dictionary=train_dictionary(pages), archive_bytes=archive_bytes)
    index = stored(marked.mapInArrow(write, INDEX), "index")
    discard(payloads, twice, revisits)
    return index


def read_archives(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the archives that an index names: RECORDS, one row per record."""
    names = stored(index.select("archive").distinct(), "archives")
    tasks = max(1, names.count())
    return names.repartition(tasks, "archive").mapInArrow(partial(_read, folder=folder, payloads=payloads), RECORDS)


def round_trip(pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Writes pages to archives in the shared folder and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    folder = new_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder, revisit_from)
    return read_archives(index, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
