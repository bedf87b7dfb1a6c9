"""WARC archives as seekable Zstandard bundles.

A bundle is one ``.warc.zst`` file: independent Zstandard frames of whole WARC
records (a frame is closed once it holds ``frame_bytes``), then a skippable
frame with the seek table of the public seekable format (compressed and
decompressed size of every frame, frame count, magic number).  An index maps
each record identifier to its bundle, frame and offset inside the frame, so
one record is read by fetching one frame.

Each task writes the bundles of its own rows straight into the shared folder
under a name of its own and returns their index rows, which Spark commits as
Parquet.  Only bundles in that index count: what a lost or repeated task left
behind is never read.  Equal payloads are found by digest: one narrow row per
digest and task is shuffled.  A Bloom filter of repeated digests lets all other
rows write where they are read; only rows whose payload may repeat are joined
(a very frequent one is split by adaptive skew handling).

Defined results: a null payload is empty; rows with a null identifier are
always responses and stand for no other row; of rows equal in identifier and
payload all that share the smallest identifier are responses; a null url gives
an empty target; control characters and spaces in a url are percent-encoded;
a very long payload fills a frame of its own, whole in one task's memory; other
columns play no part, whatever their names; an empty table gives an archive without bundles.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warehaus.llm.common import small_batches, stored
from warehaus.llm.exact_dedup import flagged, repeated_cells
from warehaus.session import scratch_path

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
# Fixed value of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
LEAST_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"
INDEX_SCHEMA = "record_id string, bundle string, frame int, frame_start long, frame_bytes long, offset long, length long"
RECORD_SCHEMA = ("record_id string, record_type string, refers_to string, target_uri string, payload_bytes long, "
                 "payload_digest string, payload binary")


# ---------------------------------------------------------------- one record

def _clean(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")


def record(record_id: str, url: str | None, size: int, digest: str, payload: bytes | None, refers_to: str | None) -> bytes:
    """A response or, with ``refers_to``, a revisit: the same headers (with the payload's true length), no payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block += payload or b""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that begins at ``at`` and the place after it; raises on damage."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    block = data[end + 4:end + 4 + int(head["Content-Length"])]
    after = end + 4 + len(block) + 4
    if len(block) != int(head["Content-Length"]) or data[after - 4:after] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = head["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    return {"record_id": head["WARC-Record-ID"][1:-1], "record_type": kind,
            "refers_to": head["WARC-Refers-To"][1:-1] if "WARC-Refers-To" in head else None,
            "target_uri": head["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest,
            "payload": payload if kind == "response" else None}, after


# ---------------------------------------------------------------- one bundle

def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", c, d) for c, d in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(f) -> list[tuple[int, int, int]]:
    """(start, compressed, decompressed) of every frame, from the end of an open file."""
    total = f.size()
    f.seek(total - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    f.seek(total - 9 - 8 * n - 8)
    mark, length = struct.unpack("<II", f.read(8))
    if mark != SKIPPABLE_MAGIC or length != 8 * n + 9:
        raise ValueError("damaged seek table")
    out, start = [], 0
    raw = f.read(8 * n)
    for i in range(n):
        c, d = struct.unpack_from("<II", raw, 8 * i)
        out.append((start, c, d))
        start += c
    return out


# Hadoop's names of stores that tasks open through Arrow, and Arrow's.
ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def store_uri(spark: SparkSession, folder: str) -> str:
    """A folder as tasks open it, resolved by Hadoop on the driver: a path without scheme is that of the default store.

    Off a plain local master such a path must not end on the machines' own disks.
    """
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    master = spark.sparkContext.master
    alone = master.startswith("local") and not master.startswith("local-cluster")
    return arrow_uri(whole, named=":" in folder.split("/", 1)[0] or alone)


def arrow_uri(whole: str, named: bool = True) -> str:
    scheme, rest = whole.split(":", 1)
    if scheme not in ARROW_SCHEMES:
        raise ValueError(f"tasks cannot open {whole}: no Arrow file system for {scheme}")
    if scheme == "file" and not named:
        raise ValueError(f"{whole} is a folder of one machine; name a shared one with its scheme")
    return f"{ARROW_SCHEMES[scheme]}:{rest}"


def open_store(uri: str):
    """(file system, path) of a resolved folder."""
    from pyarrow import fs
    return (fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")) if uri.startswith("file:") else fs.FileSystem.from_uri(uri)


class _Bundle:
    """Writes frames as they fill; holds one frame in memory."""

    def __init__(self, folder: str, frame_bytes: int, level: int):
        import zstandard
        self.store, root = open_store(folder)
        self.name = f"bundle-{uuid.uuid4().hex}.warc.zst"
        self.file = self.store.open_output_stream(f"{root}/{self.name}", compression=None)
        self.zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frame_bytes, self.frames, self.start = frame_bytes, [], 0
        self.held, self.size, self.rows = [], 0, []

    def add(self, record_id: str, data: bytes) -> Iterator[tuple]:
        self.rows.append((record_id, self.size, len(data)))
        self.held.append(data)
        self.size += len(data)
        if self.size >= self.frame_bytes:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if not self.held:
            return
        packed = self.zstd.compress(b"".join(self.held))
        self.file.write(packed)
        for record_id, offset, length in self.rows:
            yield record_id, self.name, len(self.frames), self.start, len(packed), offset, length
        self.frames.append((len(packed), self.size))
        self.start += len(packed)
        self.held, self.size, self.rows = [], 0, []

    def close(self) -> Iterator[tuple]:
        yield from self.flush()
        self.file.write(seek_table(self.frames))
        self.file.close()


# ---------------------------------------------------------------- the archive

def write_archive(df: DataFrame, id_col: str, url_col: str, payload_col: str, folder: str | None = None,
                  frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
                  least_revisit: int = LEAST_REVISIT, level: int = 3) -> str:
    """Write one record per row; returns the archive's folder (``bundles/`` and ``index/``)."""
    spark = df.sparkSession
    small_batches(spark)
    folder = folder or scratch_path(spark, "warc")
    rows = df.select(df[id_col].cast("string").alias("id"), df[id_col].alias("n"), df[url_col].alias("url"),
                     F.encode(F.coalesce(df[payload_col], F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Only rows whose payload may repeat are joined, and so shuffled; the others write where they are read.
    digests = stored(rows.where((F.length("payload") >= least_revisit) & F.col("n").isNotNull())
                     .select("digest", "n", F.xxhash64("digest").alias("h")), "warc-digests")
    first = digests.groupBy("digest").agg(F.min("n").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    cells, blocks = repeated_cells(digests, digests.count())
    names = ["id", "n", "url", "payload", "digest", "first"]
    seen = flagged(rows.withColumn("h", F.xxhash64("digest")), stored(cells, "warc-cells"), blocks)
    alone = seen.where(~F.col("maybe")).withColumn("first", F.lit(None).cast(dict(rows.dtypes)["n"]))
    rows = alone.select(*names).unionByName(seen.where("maybe").join(first, "digest", "left").select(*names))
    rows = rows.select("id", "url", "digest", F.when(F.col("n") > F.col("first"), F.col("first").cast("string")).alias("refers"),
                       F.when(F.col("n") > F.col("first"), F.lit(None)).otherwise(F.col("payload")).alias("payload"),
                       F.length("payload").alias("size"))
    _make_folder(spark, f"{folder}/bundles")
    uri = store_uri(spark, folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle, out = None, []
        for batch in batches:
            for r in batch.itertuples(index=False):
                if bundle is None:
                    bundle = _Bundle(f"{uri}/bundles", frame_bytes, level)
                rid = f"urn:page:{r.id if r.id is not None else 'null'}"
                refers = None if r.refers is None else f"urn:page:{r.refers}"
                out += bundle.add(rid, record(rid, r.url, int(r.size), r.digest, r.payload, refers))
                if bundle.start >= bundle_bytes:
                    out += bundle.close()
                    bundle = None
            if out:
                yield pd.DataFrame(out, columns=_names(INDEX_SCHEMA))
                out = []
        if bundle is not None:
            yield pd.DataFrame(list(bundle.close()), columns=_names(INDEX_SCHEMA))

    rows.mapInPandas(write, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return folder


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archive, frame by frame, by the bundles' own seek tables.

    Each bundle is a task's work; payloads are verified whether or not they are returned.
    """
    bundles = index(spark, folder).groupBy("bundle").agg(F.count("*").alias("records"))
    bundles = bundles.repartition(max(1, bundles.count()))
    uri = store_uri(spark, folder)
    schema = RECORD_SCHEMA if with_payload else RECORD_SCHEMA.removesuffix(", payload binary")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            for name, records in zip(batch["bundle"], batch["records"], strict=True):
                store, root = open_store(f"{uri}/bundles")
                seen = 0
                with store.open_input_file(f"{root}/{name}") as f:
                    for start, packed, size in read_seek_table(f):
                        f.seek(start)
                        data, at, out = zstd.decompress(f.read(packed), max_output_size=size), 0, []
                        while at < len(data):
                            r, at = parse_record(data, at)
                            out.append(r)
                        seen += len(out)
                        yield pd.DataFrame(out, columns=_names(schema))
                if seen != records:
                    raise ValueError(f"{name}: {seen} records, the index has {records}")

    return bundles.mapInPandas(read, schema)


def fetch(wanted: DataFrame, folder: str) -> DataFrame:
    """The records whose ``record_id`` is in ``wanted``: reads only the frames that hold them."""
    spark = wanted.sparkSession
    uri = store_uri(spark, folder)
    places = index(spark, folder).join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    places = places.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        zstd, at, data = zstandard.ZstdDecompressor(), None, b""
        for batch in batches:
            for r in batch.itertuples(index=False):
                if at != (r.bundle, r.frame):
                    store, root = open_store(f"{uri}/bundles")
                    with store.open_input_file(f"{root}/{r.bundle}") as f:
                        f.seek(r.frame_start)
                        data, at = zstd.decompress(f.read(r.frame_bytes)), (r.bundle, r.frame)
                yield pd.DataFrame([parse_record(data, r.offset)[0]], columns=_names(RECORD_SCHEMA))

    return places.mapInPandas(read, RECORD_SCHEMA)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _make_folder(spark: SparkSession, path: str) -> None:
    """Through Hadoop, as the shared folder may be in any store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def round_trip(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", **how) -> DataFrame:
    """Write ``df`` as an archive and return what its records say, one row each."""
    folder = write_archive(df, id_col, url_col, payload_col, **how)
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) as {dict(df.dtypes)[id_col]})")
    return stored(read_archive(df.sparkSession, folder, with_payload=False).select(
        number("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to")), "warc-read")
