"""Deterministic sharded WARC writer and reader.

``write_warc`` range-sorts the pages by page_id into shards, and each shard's
task streams its records into gzip-per-record WARC 1.1 files that roll at
``roll_bytes`` of compressed size.  Record headers and digests are generated
anew from the payload.  A file is written under a temporary name and renamed
when complete; its name depends only on shard and sequence number and its
bytes only on the rows, so a task that runs twice leaves the same file.  The
manifest (a table that Spark commits) names the files that count: readers see
nothing else.

Shards are cut by the prefix sums of payload bytes over at most ``BUCKETS``
equal ranges of page_id, so they do not depend on Spark's sampling.  A range of
more than ``shard_bytes`` is cut again: into equal ranges between its own
smallest and largest id or, where these are uneven too (an id of very many
rows, null ids, outliers on several scales), by a hash of payload and url; a
shard's records are in order of page_id either way.  Only rows alike in id, url
and payload stay together.  Pages
with equal payloads (SHA-1 and length) of at least ``min_bytes`` bytes: that
with the largest page_id is the ``response``, the others are ``revisit``
records that refer to it.  The largest ids come from a partial aggregate, so
a payload shared by a third of all pages does not meet in one task; only
payloads that repeat are joined back.

Defined cases: null html is the empty payload; a null url becomes
``urn:page:<id>``; a null page_id is the smallest id (a revisit, unless all of
its group are null: then each is a response); rows that repeat the largest
page_id of their payload are all responses.  An empty table gives an empty
archive.  Files go to the shared scratch folder through ``pyarrow.fs`` (local
or mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import stored
from pricelake.session import scratch_path

BUCKETS = 1 << 14
SHARD_BYTES = 64 << 20
ROLL_BYTES = 8 << 20
WARC_DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = ("file string, shard int, seq int, records long, bytes long, "
            "sha256 string")


def _filesystem(uri: str):
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def _b32(raw: bytes) -> str:
    return base64.b32encode(raw).decode()


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _head(lines) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines)
            + "\r\n").encode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def warc_record(page_id, url, payload: bytes, response_id, revisit: bool) -> bytes:
    """One uncompressed record."""
    digest = _b32(hashlib.sha1(payload).digest())
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if revisit else http + payload
    target = "".join(c if c.isprintable() and c != " " else
                     "".join(f"%{b:02X}" for b in c.encode())
                     for c in (url or f"urn:page:{page_id}"))
    lines = [("WARC-Type", "revisit" if revisit else "response"),
             ("WARC-Record-ID", _record_id(page_id, digest)),
             ("WARC-Target-URI", target), ("WARC-Date", WARC_DATE),
             ("WARC-Payload-Digest", f"sha1:{digest}"),
             ("WARC-Block-Digest",
              f"sha1:{_b32(hashlib.sha1(block).digest())}"),
             ("X-Page-Id", "" if page_id is None else page_id),
             ("X-Payload-Length", len(payload))]
    if revisit:
        lines += [("WARC-Profile", PROFILE),
                  ("WARC-Refers-To", _record_id(response_id, digest)),
                  ("X-Refers-To-Page-Id", response_id)]
    lines += [("Content-Type", "application/http;msgtype=response"),
              ("Content-Length", len(block))]
    return _head(lines) + block + b"\r\n\r\n"


class _Roller:
    """The files of one shard."""

    def __init__(self, uri: str, shard: int, roll_bytes: int):
        self.fs, self.root = _filesystem(uri)
        self.shard, self.roll, self.seq = shard, roll_bytes, 0
        self.out = None

    def _open(self):
        self.name = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
        self.tmp = f"{self.root}/.{self.name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.tmp)
        self.size = self.records = 0
        self.sha = hashlib.sha256()
        info = f"software: pricelake\r\nfilename: {self.name}\r\n".encode()
        self._put(_head([
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(self.name, "")),
            ("WARC-Date", WARC_DATE), ("WARC-Filename", self.name),
            ("Content-Type", "application/warc-fields"),
            ("Content-Length", len(info))]) + info + b"\r\n\r\n")

    def _put(self, record: bytes):
        data = _member(record)
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def add(self, record: bytes):
        """Returns the manifest row of a file that this record filled."""
        if self.out is None:
            self._open()
        self._put(record)
        self.records += 1
        return self.close() if self.size >= self.roll else None

    def _rename(self):
        """A complete file of that name, left by another attempt, holds the same
        bytes and stays (some file systems refuse to replace it)."""
        from pyarrow.fs import FileType
        final = f"{self.root}/{self.name}"

        def there():
            return self.fs.get_file_info(final).type == FileType.File
        if not there():
            try:
                self.fs.move(self.tmp, final)
                return
            except OSError:
                if not there():
                    raise
        self.fs.delete_file(self.tmp)

    def close(self):
        if self.out is None:
            return None
        self.out.close()
        self._rename()
        self.out = None
        row = (self.name, self.shard, self.seq, self.records, self.size,
               self.sha.hexdigest())
        self.seq += 1
        return row


def _writer(uri: str, roll_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, roller = [], None

        def flush():
            rows, done[:] = list(done), []
            cols = list(zip(*rows))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(),
                     pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, kinds)],
                names=["file", "shard", "seq", "records", "bytes", "sha256"])

        for batch in batches:
            shard, page, url, payload, response, revisit = batch.columns
            for i in range(batch.num_rows):
                s = shard[i].as_py()
                if roller is None or roller.shard != s:
                    if roller is not None and (row := roller.close()):
                        done.append(row)
                    roller = _Roller(uri, s, roll_bytes)
                row = roller.add(warc_record(
                    page[i].as_py(), url[i].as_py(), payload[i].as_py(),
                    response[i].as_py(), revisit[i].as_py()))
                if row:
                    done.append(row)
            if done:
                yield flush()
        if roller is not None and (row := roller.close()):
            done.append(row)
        if done:
            yield flush()
    return write


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_bytes: int = 0,
               shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
               ) -> tuple[str, DataFrame]:
    """Write the archive; returns its folder and its manifest."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"),
                        F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")) \
        .withColumn("n", F.length("payload"))

    keys = stored(rows.select("page_id", "sha", "n"), "warc-keys")
    # stored, so that its size is known: payloads stay where they are unless
    # the repeated ones are too many to broadcast
    same = stored(keys.where(F.col("n") >= min_bytes).groupBy("sha", "n")
                  .agg(F.max("page_id").alias("response"),
                       F.count("*").alias("copies"))
                  .where("copies > 1").drop("copies"), "warc-same")

    span = keys.agg(F.min("page_id"), F.max("page_id"), F.count("*"),
                    F.sum("n")).first()
    low, high, total = span[0] or 0, span[1] or 0, int(span[3] or 0)

    def bucket(col):
        return F.least(F.lit(BUCKETS - 1), F.floor(
            (col - low).cast("double") * (BUCKETS / (high - low + 1.0)))) \
            .cast("int")
    at = F.coalesce(bucket(F.col("page_id")), F.lit(-1))
    upto = F.sum("bytes").over(Window.orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1))
    # at most BUCKETS + 1 rows, whatever the input: windowed and broadcast
    cuts = stored(
        keys.groupBy(at.alias("bucket")).agg(
            F.sum("n").alias("bytes"), F.min("page_id").alias("least"),
            F.max("page_id").alias("most"))
        .select("bucket", "least", "most",
                F.floor(F.coalesce(upto, F.lit(0)) / shard_bytes).cast("int")
                .alias("first"),
                F.greatest(F.lit(1), F.ceil(F.col("bytes") / shard_bytes))
                .cast("int").alias("parts")), "warc-cuts")
    by_id = F.coalesce(F.least(F.col("parts") - 1, F.floor(
        (F.col("page_id") - F.col("least")).cast("double") * F.col("parts")
        / (F.col("most") - F.col("least") + 1.0)).cast("int")), F.lit(0))
    uneven = (keys.withColumn("bucket", at)
              .join(F.broadcast(cuts.where("parts > 1")), "bucket")
              .groupBy("bucket", by_id.alias("part"))
              .agg(F.sum("n").alias("bytes"))
              .groupBy("bucket").agg(F.max("bytes").alias("bytes"))
              .where(F.col("bytes") > 2 * shard_bytes)
              .select("bucket", F.lit(True).alias("uneven")))
    cuts = cuts.join(uneven, "bucket", "left")
    by_hash = F.pmod(F.xxhash64("sha", "url"), F.col("parts")).cast("int")
    shards = total // shard_bytes + 1

    full = (rows.withColumn("bucket", at)
            .join(F.broadcast(cuts), "bucket")
            .withColumn("shard", F.col("first") + F.when(
                F.col("uneven"), by_hash).otherwise(by_id))
            .join(same, ["sha", "n"], "left")
            .withColumn("revisit", F.col("response").isNotNull()
                        & ~F.col("page_id").eqNullSafe(F.col("response"))))
    full = (full.repartitionByRange(int(shards), "shard")
            .sortWithinPartitions("shard", "page_id", "sha", "url")
            .select("shard", "page_id", "url", "payload", "response", "revisit"))
    folder = scratch_path(spark, "warc")
    fs, root = _filesystem(folder)
    fs.create_dir(root, recursive=True)
    manifest = stored(full.mapInArrow(_writer(folder, roll_bytes), MANIFEST),
                      "warc-manifest")
    return folder, manifest


def _records(stream) -> Iterator[tuple[dict, bytes]]:
    """Headers and block of every record of an open archive file."""
    z, buf = zlib.decompressobj(31), bytearray()
    ended = False

    def fill() -> bool:
        nonlocal z, ended
        while not ended:
            raw = z.unused_data or stream.read(1 << 18)
            if not raw:
                ended = True
                return False
            if z.eof:
                z = zlib.decompressobj(31)
            buf.extend(z.decompress(raw))
            if buf:
                return True
        return False

    while True:
        while (end := buf.find(b"\r\n\r\n")) < 0:
            if not fill():
                if buf.strip():
                    raise ValueError("truncated archive")
                return
        head = buf[:end].decode().split("\r\n")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "")
                       for x in head[1:])
        size = int(headers["Content-Length"])
        need = end + 4 + size + 4
        while len(buf) < need:
            if not fill():
                raise ValueError("truncated archive")
        yield headers, bytes(buf[end + 4:end + 4 + size])
        del buf[:need]


def read_warc(folder: str, manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    record of the archive; block and payload digests are verified."""
    schema = ("page_id long, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long, url string")

    def number(x):
        return int(x) if x else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                 pa.string()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type",
                 "refers_to", "url"]
        for batch in batches:
            for name, count in zip(batch.column(0).to_pylist(),
                                   batch.column(1).to_pylist()):
                rows = []
                with fs.open_input_stream(f"{root}/{name}",
                                          compression=None) as stream:
                    for h, block in _records(stream):
                        if h["WARC-Type"] == "warcinfo":
                            continue
                        sha = _b32(hashlib.sha1(block).digest())
                        if h["WARC-Block-Digest"] != f"sha1:{sha}":
                            raise ValueError(f"block digest in {name}")
                        digest = h["WARC-Payload-Digest"][5:]
                        size = int(h["X-Payload-Length"])
                        if h["WARC-Type"] == "response":
                            body = block[block.index(b"\r\n\r\n") + 4:]
                            if len(body) != size or digest != _b32(
                                    hashlib.sha1(body).digest()):
                                raise ValueError(f"payload digest in {name}")
                        rows.append((number(h["X-Page-Id"]), size, digest,
                                     h["WARC-Type"],
                                     number(h.get("X-Refers-To-Page-Id")),
                                     h["WARC-Target-URI"]))
                if len(rows) != count:
                    raise ValueError(f"{name}: {len(rows)} of {count} records")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)],
                    names=names)

    files = manifest.select("file", "records")
    n = max(1, min(files.count(), 10_000))
    return files.repartitionByRange(n, "file").mapInArrow(read, schema)
