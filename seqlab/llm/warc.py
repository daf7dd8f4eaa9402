"""WARC archives: a deterministic sharded writer, and a reader.

Records are sorted into contiguous page-id ranges of bounded size, so the same
pages give the same shards in every run. Each shard is written in page order as
gzip members, one per record, rolling to a new file when the compressed size
reaches ``roll_bytes``; headers and digests are made from the payload. A task
writes under a temporary name of its own and returns a manifest row; only files
in the manifest are renamed, by a job that can be repeated, and readers follow
the committed manifest. A task that is run twice leaves at most an unnamed file.

Of equal payloads of at least ``least`` bytes the smallest page id is stored as
response, the others as revisits of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqlab.llm.common import id_ranges, work_folder

LEAST_SHARD, MOST_SHARD, SHARDS = 1 << 20, 64 << 20, 64
ROLL_BYTES = 16 << 20
LEAST_BYTES = 0
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "temporary string, name string, records long, bytes long, sha256 string"
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, payload binary")
_NO_ID = (1 << 63) - 1   # comes last


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int) -> str:
    return f"<urn:page:{'none' if page_id == _NO_ID else page_id}>"


def _number(name: str) -> int | None:
    n = re.fullmatch(r"<urn:page:(-?\d+|none)>", name)[1]
    return None if n == "none" else int(n)


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record, uncompressed; a revisit holds the HTTP head only."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
            "\r\n\r\n").encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of a record; digests and lengths are verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if not first.startswith("WARC/1.") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("damaged record")
    if fields["WARC-Type"] == "warcinfo":
        return {"record_type": "warcinfo"}
    if fields["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
        raise ValueError(f"block digest differs: {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"payload differs: {fields['WARC-Record-ID']}")
    return {"page_id": _number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"),
            "record_type": fields["WARC-Type"], "payload_bytes": size, "payload_digest": digest,
            "refers_to": _number(fields["WARC-Refers-To"]) if revisit else None,
            "payload": None if revisit else payload}


def _info_record(name: str) -> bytes:
    block = b"software: seqlab\r\nformat: WARC File Format 1.1\r\n"
    return (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:file:{name}>\r\nWARC-Date: {DATE}\r\n"
            f"WARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\n"
            f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def _shard_writer(folder: str, roll_bytes: int, level: int):
    def write(key, pages, info):
        store, root = fs.FileSystem.from_uri(folder)
        attempt = f"{root}/temporary/{uuid.uuid4().hex}"
        store.create_dir(attempt, recursive=True)
        shard = key[0].as_py()
        first = dict(zip(zip(info["of_id"].to_pylist(), info["of_hash"].to_pylist()), info["response"].to_pylist()))
        pages = pages.sort_by([("id", "ascending"), ("row_hash", "ascending")])
        rows, parts, size, count = [], [], 0, 0

        def flush():
            nonlocal parts, size, count
            name = f"part-{shard:06d}-{len(rows):04d}.warc.gz"
            data = gzip.compress(_info_record(name), level, mtime=0) + b"".join(parts)
            with store.open_output_stream(f"{attempt}/{name}", compression=None) as f:
                f.write(data)
            rows.append({"temporary": f"{attempt}/{name}", "name": name, "records": count, "bytes": len(data),
                         "sha256": hashlib.sha256(data).hexdigest()})
            parts, size, count = [], 0, 0

        for batch in pages.to_batches(max_chunksize=256):
            for i, h, url, text in zip(*(batch.column(c).to_pylist() for c in ("id", "row_hash", "url", "text"))):
                of = first.get((i, h), i)
                parts.append(gzip.compress(record(i, url, text.encode("utf-8"), None if of == i else of),
                                           level, mtime=0))
                size += len(parts[-1])
                count += 1
                if size >= roll_bytes:
                    flush()
        if parts:
            flush()
        return pa.Table.from_pylist(rows, schema=pa.schema([
            ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()),
            ("sha256", pa.string())]))
    return write


def _committer(folder: str):
    def commit(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for temporary, name, size in zip(*(batch.column(c).to_pylist() for c in ("temporary", "name", "bytes"))):
                final = f"{root}/{name}"
                if store.get_file_info(final).size != size:    # not renamed yet
                    store.move(temporary, final)
            yield batch
    return commit


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", least: int = LEAST_BYTES, shard_bytes: int | None = None,
                   roll_bytes: int = ROLL_BYTES, level: int = LEVEL) -> DataFrame:
    """Write ``pages`` below ``folder`` and return the committed manifest.

    Null payloads are empty; a null url leaves the header out; null ids come
    last, as one id that equal payloads refer to only if no page has an id.
    Without ``shard_bytes`` a shard gets a 64th of the payload bytes, at least
    1 MB and at most 64 MB; a task holds less than twice that, or one page.
    The rows of one id that fill more than a shard (as those without an id may)
    are cut into several in the order of a hash.
    Rows with equal id and payload are all responses or all revisits. An empty
    table gives an empty manifest.
    """
    spark = pages.sparkSession
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"),
                        F.col(url_col).cast("string").alias("url"), text.alias("text"))
    rows = rows.withColumn("row_hash", F.xxhash64("text"))
    keys = rows.select("id", "row_hash", F.sha2("text", 256).alias("digest"),
                       F.octet_length("text").alias("size"))
    # only pages that share a payload need to know its first one
    many = keys.where(F.col("size") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    info = keys.join(many.where("first <> last"), "digest").where("id <> first").select(
        "id", "row_hash", "first").distinct()

    if shard_bytes is None:
        total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        shard_bytes = min(MOST_SHARD, max(LEAST_SHARD, total // SHARDS))
    ranged, _ = id_ranges(rows, F.octet_length("text") + 500, shard_bytes, "shard")
    held = ranged.select("shard", "id", "row_hash", "url", "text")
    told = info.join(held.select("id", "row_hash", "shard").distinct(), ["id", "row_hash"]).select(
        F.col("shard").alias("of_shard"), F.col("id").alias("of_id"), F.col("row_hash").alias("of_hash"),
        F.col("first").alias("response"))
    written = held.groupBy("shard").cogroup(told.groupBy("of_shard")).applyInArrow(
        _shard_writer(folder, roll_bytes, level), MANIFEST)
    written.write.parquet(f"{folder}/written")                     # tasks end before anything is renamed
    spark.read.parquet(f"{folder}/written").mapInArrow(_committer(folder), MANIFEST).write.parquet(
        f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _split(data: bytes):
    """The gzip members of a file, decompressed."""
    view, at = memoryview(data), 0
    while at < len(data):
        member, out = zlib.decompressobj(wbits=31), []
        while not member.eof:
            piece = view[at:at + (1 << 16)]
            if not piece:
                raise ValueError("truncated member")
            out.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
        yield b"".join(out)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all committed files; each file is verified and read by one
    task, holding at most that file (``roll_bytes`` and a record)."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("payload", pa.binary())])

    def read(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, sha256 in zip(batch.column("name").to_pylist(), batch.column("sha256").to_pylist()):
                with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                    data = f.read()
                if hashlib.sha256(data).hexdigest() != sha256:
                    raise ValueError(f"{name} differs from its manifest")
                rows = [r for r in map(parse_record, _split(data)) if r["record_type"] != "warcinfo"]
                for i in range(0, len(rows), 512):
                    yield pa.RecordBatch.from_pylist(rows[i:i + 512], schema=schema)

    files = read_manifest(spark, folder)
    return files.repartition(max(1, files.count()), "name").mapInArrow(read, RECORD)


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a new folder of the shared checkpoint folder and read
    the records back."""
    folder = work_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, **options)
    return read_archives(pages.sparkSession, folder)
