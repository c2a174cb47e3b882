"""WARC archives of Zstandard frames with a shared dictionary: writer and reader.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary; then every record is one
frame. The dictionary is trained on a bounded sample of the archive's first payloads. The reader loads the
dictionary, decodes frame after frame from a stream and checks version line, headers, lengths and digests.

Payloads of at least ``least`` bytes that are equal (by SHA-1) are stored once: the copy with the largest page id is
a ``response``, the others ``revisit`` it; their HTTP header keeps the payload's length. The largest id per digest is
a combining aggregate, and the join back is a plain equi join on the digest that adaptive execution splits when one
payload makes up a large share of the rows. Tasks write archives into a shared folder under names of their own and
return a manifest, so an archive of a lost or repeated task is never read. A task goes on with a new archive once one
holds ``limit`` bytes.

A null payload is empty. Null ids are written as such and read back as null; they neither keep nor revisit. Rows
repeated with the largest id are all responses. Line ends, blanks and control characters in a url are percent-encoded
in the header and the url is read back as it was. An empty table writes no archive and gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import urllib.parse
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.common import batches, checkpoint_dir, materialize

MAGIC = 0x184D2A5D
MANIFEST = "archive string, n_records long, n_bytes long"
_MANIFEST = pa.schema([("archive", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "html string")
_RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                      ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                      ("html", pa.string())])
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = re.compile(r"<urn:page:(-?\d+|none)(?::\d+)?>")


class BadArchive(ValueError):
    """An archive that does not hold what its headers say."""


def record(page_id, url, payload: bytes, digest: str, keeper, serial: int) -> bytes:
    """One WARC record; ``keeper`` is the page it revisits, or None for a response."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            ).encode()
    block = http if keeper is not None else http + payload
    fields = [("WARC-Type", "response" if keeper is None else "revisit"),
              ("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}:{serial}>"),
              ("WARC-Date", "1970-01-01T00:00:00Z")]
    if url is not None:
        fields.append(("WARC-Target-URI", urllib.parse.quote(url, safe="!#$&'()*+,/:;=?@[]~")))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if keeper is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{keeper}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int) -> zstandard.ZstdCompressionDict:
    """A dictionary from a few records; too few to train on serve as the dictionary themselves."""
    try:
        return zstandard.train_dictionary(size, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:size].ljust(8, b" "),
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(out, records, sample: int = 256, size: int = 16_384, limit: int = 64 << 20) -> tuple[int, int, bool]:
    """Write records (bytes) until about ``limit`` bytes; (records, bytes, whether the iterator may hold more)."""
    first, taken = [], 0
    for raw in records:
        first.append(raw)
        taken += len(raw)
        if len(first) >= sample or taken >= limit:
            break
    if not first:
        return 0, 0, False
    trained = train([r[:8192] for r in first], size)
    raw = trained.as_bytes()
    out.write(MAGIC.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw)
    packer = zstandard.ZstdCompressor(dict_data=trained, write_content_size=True, write_checksum=True)
    n, done, written = 0, 0, 8 + len(raw)
    for part in (first, records):
        for raw in part:
            frame = packer.compress(raw)
            out.write(frame)
            n, done, written = n + 1, done + len(raw), written + len(frame)
            if part is records and done >= limit:
                return n, written, True
        if done >= limit:
            return n, written, True
    return n, written, False


def frames(stream, step: int = 65_536):
    """Decoded frames of an archive, one at a time, from a stream of bytes."""
    head = stream.read(8)
    if len(head) < 8 or int.from_bytes(head[:4], "little") != MAGIC:
        raise BadArchive("no dictionary frame at the start")
    size = int.from_bytes(head[4:], "little")
    raw = stream.read(size)
    if len(raw) < size:
        raise BadArchive("the dictionary is cut off")
    packed = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    buffer, decoder, parts = b"", None, []
    while True:
        if not buffer:
            buffer = stream.read(step)
            if not buffer:
                if decoder is not None:
                    raise BadArchive("the last frame is cut off")
                return
        if decoder is None:
            decoder, parts = packed.decompressobj(), []
        try:
            parts.append(decoder.decompress(buffer))
        except zstandard.ZstdError as e:
            raise BadArchive(str(e)) from e
        buffer = decoder.unused_data if decoder.eof else b""
        if decoder.eof:
            yield b"".join(parts)
            decoder = None


def parse(raw: bytes) -> tuple:
    """(page_id, url, payload_bytes, digest, type, refers_to, payload) of one record, checked."""
    at = raw.find(b"\r\n\r\n")
    lines = raw[:max(at, 0)].decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise BadArchive("no WARC version line")
    head = dict(line.split(": ", 1) for line in lines[1:])
    try:
        kind, length, digest = head["WARC-Type"], int(head["Content-Length"]), head["WARC-Payload-Digest"]
        page = _ID.fullmatch(head["WARC-Record-ID"])[1]
    except (KeyError, ValueError, TypeError) as e:
        raise BadArchive(f"header missing or malformed: {e}") from e
    block = raw[at + 4:-4]
    if len(block) != length or raw[-4:] != b"\r\n\r\n":
        raise BadArchive("the block's length is not its Content-Length")
    stop = block.find(b"\r\n\r\n") + 4
    http = dict(line.split(": ", 1) for line in block[:stop - 4].decode("utf-8").split("\r\n")[1:])
    n, payload = int(http["Content-Length"]), block[stop:]
    refers = None
    if kind == "response":
        if len(payload) != n or "sha1:" + hashlib.sha1(payload).hexdigest() != digest:
            raise BadArchive("the payload is not what its length and digest say")
    elif kind == "revisit":
        if payload or "WARC-Refers-To" not in head:
            raise BadArchive("a revisit holds no payload and names its response")
        refers = int(_ID.fullmatch(head["WARC-Refers-To"])[1])
    else:
        raise BadArchive(f"unexpected record type {kind}")
    url = head.get("WARC-Target-URI")
    return (None if page == "none" else int(page), None if url is None else urllib.parse.unquote(url), n,
            digest.removeprefix("sha1:"), kind, refers, payload)


def write(pages: DataFrame, folder: str | None = None, least: int = 1000, limit: int = 64 << 20) -> DataFrame:
    """Write archives of all pages into a shared folder; the manifest (archive, n_records, n_bytes), already stored."""
    folder = folder or f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html")) \
        .withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    keepers = rows.where(F.octet_length("html") >= least).groupBy(F.col("digest").alias("same")) \
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    dealt = rows.join(keepers, F.col("digest") == F.col("same"), "left") \
        .select("page_id", "url", "html", "digest",
                F.when(F.col("page_id") != F.col("keeper"), F.col("keeper")).alias("keeper"))

    def archives(found):
        def records():
            serial = 0
            for batch in found:
                for page, url, html, digest, keeper in zip(*(c.to_pylist() for c in batch.columns)):
                    yield record(page, url, html.encode("utf-8", "surrogatepass"), digest, keeper, serial)
                    serial += 1

        store, base = fs.FileSystem.from_uri(folder)
        source, more = records(), True  # goes on behind a full archive, so nothing may close it
        while more:
            name = f"pages-{uuid.uuid4().hex}.warc.zst"
            first = next(source, None)
            if first is None:
                return
            store.create_dir(base, recursive=True)
            with store.open_output_stream(f"{base}/{name}") as out:
                n, size, more = write_archive(out, itertools.chain([first], source), limit=limit)
            yield f"{folder}/{name}", n, size

    def run(found):
        yield from batches(archives(found), _MANIFEST)

    return materialize(dealt.mapInArrow(run, MANIFEST), "warc-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """Every record of the manifest's archives, validated; an archive is one task's stream."""

    def records(found):
        for batch in found:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = fs.FileSystem.from_uri(path)
                n = 0
                with store.open_input_stream(name) as stream:
                    for raw in frames(stream):
                        *row, payload = parse(raw)
                        yield (*row, payload.decode("utf-8", "surrogatepass") if row[4] == "response" else None)
                        n += 1
                if n != expected:
                    raise BadArchive(f"{path} holds {n} records, its manifest says {expected}")

    def run(found):
        yield from batches(records(found), _RECORDS, 1024)

    n = max(1, manifest.count())  # archives, of ``limit`` bytes each: one task for about one archive
    return manifest.select("archive", "n_records").repartitionByRange(n, "archive").mapInArrow(run, RECORDS)
