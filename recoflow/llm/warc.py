"""WARC archives with dictionary-compressed records.

A Zstandard dictionary is built from a bounded sample of the payloads. Each
archive starts with a skippable frame that holds it (magic 0x184D2A5D), then
every record is a frame of its own, so a record can be read from its offset
alone. Of equal payloads of at least ``min_bytes`` the one with the largest
page_id is a response, the others are revisit records without payload that name it.

Tasks write to the shared folder under names of their own and return them; the
written manifest holds what counts, so archives of lost or repeated tasks are
never read. Records stream in both directions, one at a time.

Defined results: a null payload is empty; rows with equal id and payload are all
responses if that id is the largest; null ids come last, and a payload that only
they have is a response each time; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoflow.llm.common import read
from recoflow.session import materialize, scratch_dir

MAGIC = 0x184D2A5D
SAMPLE_RECORDS = 512
SAMPLE_RECORD_BYTES = 1 << 17     # a sampled record is at most this long
DICTIONARY_BYTES = 112_640
ARCHIVE_BYTES = 256 << 20         # of payload; then a task begins another archive
LEVEL = 3


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_dictionary(pages: DataFrame, payload: str = "html", key: str = "page_id") -> bytes:
    """A dictionary from ``SAMPLE_RECORDS`` payloads, those with the smallest hash; empty if there are too few."""
    import zstandard
    rows = (pages.filter(F.octet_length(payload).between(1, SAMPLE_RECORD_BYTES))
            .select(F.col(payload).alias("p"), F.pmod(F.xxhash64(key, payload), F.lit(1 << 40)).alias("h")))
    # only rows that can be among the smallest leave their tasks
    share = min(1.0, 4 * SAMPLE_RECORDS / max(1, pages.count()))
    rows = rows.filter(F.col("h") < int(share * (1 << 40))).orderBy("h", "p").limit(SAMPLE_RECORDS).collect()
    samples = [r.p.encode() for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:        # too little or too uniform content
        return b""


def _filesystem(path: str):
    import pyarrow.fs
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    return pyarrow.fs.FileSystem.from_uri(path)


def record(kind: str, page_id, url: str | None, payload: bytes, payload_digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has no payload but the digest and the record it refers to."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha1:{payload_digest}", "Content-Type: text/html; charset=utf-8",
             f"Content-Length: {len(payload)}"]
    if url:
        lines.append("WARC-Target-URI: " + "".join(url.splitlines()))
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {name(refers_to)}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[:int(fields["Content-Length"])]


def _writer(folder: str, dictionary: bytes):
    def run(batches):
        import zstandard
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary \
            else zstandard.ZstdCompressor(level=LEVEL)
        out, path, size, count = None, "", 0, 0
        fs, base = _filesystem(folder)
        done = lambda: pa.RecordBatch.from_arrays([pa.array([f"{folder}/{path}"]), pa.array([count])], names=["path", "records"])
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, size, count = f"part-{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = fs.open_output_stream(f"{base}/{path}", compression=None)
                    out.write(struct.pack("<II", MAGIC, len(dictionary)) + dictionary)
                payload = row["payload"] or b""
                kind = "revisit" if row["refers_to"] is not None else "response"
                out.write(packer.compress(record(kind, row["page_id"], row["url"], b"" if kind == "revisit" else payload,
                                                 row["digest"], row["refers_to"])))
                size, count = size + len(payload), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield done()
        if out is not None:
            out.close()
            yield done()
    return run


def _based(batches):
    for batch in batches:
        hexes = batch.column("digest").to_pylist()
        column = pa.array([base64.b32encode(bytes.fromhex(h)).decode() for h in hexes], pa.string())
        at = batch.schema.get_field_index("digest")
        yield batch.set_column(at, "digest", column)


def write(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, payload: str = "html",
          key: str = "page_id", url: str = "url") -> DataFrame:
    """Archives ``pages`` and returns the manifest (path, records)."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    fs, base = _filesystem(folder)
    fs.create_dir(base, recursive=True)
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload"), F.sha1(body).alias("digest"))
    first = (rows.select("page_id", "digest", F.octet_length("payload").alias("n")).filter(F.col("n") >= min_bytes)
             .groupBy("digest").agg(F.max("page_id").alias("original")))
    rows = rows.join(first, "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    rows = rows.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "digest",
                       F.when(revisit, F.col("original")).alias("refers_to"))
    rows = rows.mapInArrow(_based, "page_id long, url string, payload binary, digest string, refers_to long")
    dictionary = build_dictionary(pages, payload, key)
    return materialize(rows.mapInArrow(_writer(folder, dictionary), "path string, records long"), "manifest")


def frames(stream):
    """The dictionary and the records of an archive, one at a time."""
    import zstandard
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != MAGIC:
        raise ValueError("the archive has no leading dictionary frame")
    dictionary = stream.read(size)
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    unpack = lambda: (zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()).decompressobj()
    rest = b""
    while True:
        one, parts = unpack(), []
        while not one.eof:
            chunk = rest or stream.read(1 << 20)
            if not chunk:
                if parts:
                    raise ValueError("the archive ends within a record")
                return
            parts.append(one.decompress(chunk))
            rest = one.unused_data if one.eof else b""
        yield b"".join(parts)


def _reader(batches):
    names = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    number = lambda name: int(name[len("<urn:page:"):-1]) if name and len(name) > len("<urn:page:>") else None
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, place = _filesystem(path)
            rows = []
            with fs.open_input_stream(place, compression=None) as stream:
                for data in frames(stream):
                    fields, payload = parse(data)
                    kind, said = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and digest(payload) != said:
                        raise ValueError(f"a payload in {path} does not match its digest")
                    rows.append((number(fields["WARC-Record-ID"]), kind, len(payload) if kind == "response" else None, said,
                                 number(fields.get("WARC-Refers-To"))))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def read_back(manifest: DataFrame) -> DataFrame:
    """(page_id, record_type, payload_bytes, payload_digest, refers_to) of every record; a revisit has its response's length."""
    rows = materialize(manifest.select("path").repartition("path").mapInArrow(
        _reader, "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long"), "records")
    sizes = (rows.filter("record_type = 'response'").groupBy("payload_digest")
             .agg(F.max("payload_bytes").alias("full_bytes")))
    again = rows.filter("record_type = 'revisit'").join(sizes, "payload_digest", "left").withColumn("payload_bytes", F.col("full_bytes"))
    return rows.filter("record_type = 'response'").unionByName(again.select(*rows.columns))


def op2_dictionary_warc(spark, sf_dir: str) -> DataFrame:
    back = read_back(write(read(spark, sf_dir, "pages")))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
