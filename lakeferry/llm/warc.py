"""WARC archives: writing, and normalising monolithic gzip to one member a record.

`write_archives` writes each partition of pages as one whole-file gzip stream. `normalise` inflates such a
stream once, in pieces, finds its records by their Content-Length, rewrites each as a gzip member of its own
and writes a sidecar index of offsets (JSON lines), so that `read_archives` reads any record by one range request.
A record of any length passes in pieces of _PIECE bytes.

Of pages whose payloads (html in UTF-8) are equal and have at least `least` bytes, those with the
smallest page_id are responses, the others revisits, which carry headers alone.

Cases: null html = empty payload, a response. Null url: an empty target. Null page_ids are kept; they name no response unless
all equal pages have none, and then all of these are responses. Rows that repeat the smallest page_id are responses each. An empty
table, and an empty partition, write no archive. Other columns are left out. A stream that ends within a record is an error.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, file_system, write_whole

LEAST = 100
#: Groups of equal payloads (about 100 bytes each) that go to all executors; more are joined by a shuffle.
BROADCAST_GROUPS = 500_000
_PIECE = 1 << 20
_DATE = "2024-01-01T00:00:00Z"
INDEX = "file string, offset bigint, length bigint, type string, page_id bigint"
RAW, ONE = ".raw.warc.gz", ".warc.gz"


def decide(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html, bytes, digest, refers_to (null for responses)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("bigint")).withColumn("digest", F.sha2("html", 256))
    groups = rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    groups = cut(groups.where("n > 1 and first is not null").select(F.col("digest").alias("_digest"), "first"))
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    out = rows.join(groups, (F.col("digest") == F.col("_digest")) & (F.col("bytes") >= least), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return out.select("page_id", "url", "html", "bytes", "digest", refers.alias("refers_to"))


def _id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or if refers_to is set a revisit, as bytes."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    url = re.sub(r"[\x00-\x20\x7F]", lambda m: f"%{ord(m[0]):02X}", url)
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _id(page_id, digest), "WARC-Target-URI": url, "WARC-Date": _DATE, "WARC-Payload-Digest": f"sha256:{digest}", "X-Page-Id": "" if page_id is None else page_id}
    if refers_to is not None:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": _id(refers_to, digest), "X-Refers-To-Page": refers_to}
        payload = b""
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(http) + len(payload)}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + http + payload + b"\r\n\r\n"


def headers(block: bytes) -> dict[str, str]:
    """Fields of a head, by lower-case name."""
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes decide()'s rows as monolithic gzip streams into folder; their names (name)."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        name = f"part-{TaskContext.get().partitionId():05d}"

        def fill(out):
            z, batch = zlib.compressobj(1, zlib.DEFLATED, 31), first
            while batch is not None:
                for page, url, html, _, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    out.write(z.compress(record(page, url, html, digest, refers)))
                batch = next(batches, None)
            out.write(z.flush())

        write_whole(folder, name + RAW, fill)
        yield pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    return cut(rows.mapInArrow(run, "name string"))


class _Inflated:
    """A gzip stream of any number of members, read once."""

    def __init__(self, source):
        self.source, self.z, self.held, self.at = source, zlib.decompressobj(31), bytearray(), 0

    def more(self) -> bool:
        while True:
            if self.z.eof:
                raw = self.z.unused_data or self.source.read(_PIECE)
                if not raw:
                    return False
                self.z = zlib.decompressobj(31)
            elif self.z.unconsumed_tail:
                raw = self.z.unconsumed_tail
            else:
                raw = self.source.read(_PIECE)
                if not raw:
                    raise ValueError("the gzip stream ends early")
            got = self.z.decompress(raw, _PIECE)
            if got:
                del self.held[: self.at]  # once a piece, not once a record
                self.at = 0
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with mark; None at the end."""
        seen = 0
        while (to := self.held.find(mark, self.at + seen)) < 0:
            seen = max(0, len(self.held) - self.at - len(mark))
            if not self.more():
                if self.held[self.at :].strip():
                    raise ValueError("the stream ends within a head")
                return None
        return self._take(to + len(mark) - self.at)

    def _take(self, n: int) -> bytes:
        out = bytes(memoryview(self.held)[self.at : self.at + n])
        self.at += len(out)
        return out

    def pieces(self, n: int):
        while n:
            if self.at == len(self.held) and not self.more():
                raise ValueError("the stream ends within a record")
            out = self._take(n)
            n -= len(out)
            yield out


def normalise(source, out):
    """Copies the records of a gzip stream to out, each as its own member; yields offset, length, head's fields."""
    stream, at = _Inflated(source), 0
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = headers(head.lstrip(b"\r\n")[:-4])
        z, n = zlib.compressobj(6, zlib.DEFLATED, 31), 0
        n += out.write(z.compress(head.lstrip(b"\r\n"))) or 0
        size = 0
        for piece in stream.pieces(int(fields["content-length"]) + 4):
            data = z.compress(piece)
            out.write(data)
            size += len(data)
        data = z.flush()
        out.write(data)
        size += len(data) + n
        yield at, size, fields
        at += size


class _Counted:
    """A stream that returns what it has written."""

    def __init__(self, out):
        self.out = out

    def write(self, data: bytes) -> int:
        self.out.write(data)
        return len(data)


def normalise_all(names: DataFrame, folder: str) -> DataFrame:
    """Normalises the archives of folder that names (name) lists, and drops the originals; the index of offsets, read from the sidecars."""

    def run(batches):
        import pyarrow as pa

        fs, at = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                lines = []

                def fill(out, name=name, lines=lines):
                    with fs.open_input_stream(f"{at}/{name}{RAW}", compression=None) as source:
                        for offset, length, f in normalise(source, _Counted(out)):
                            page = f.get("x-page-id", "")
                            lines.append(json.dumps({"file": name + ONE, "offset": offset, "length": length, "type": f["warc-type"], "page_id": int(page) if page else None}))

                write_whole(folder, name + ONE, fill)
                write_whole(folder, f"{name}.idx.json", lambda out, lines=lines: out.write("".join(x + "\n" for x in lines).encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    n = names.count()
    done = cut(names.repartition(max(1, min(n, 4096))).mapInArrow(run, "name string"))
    spark = names.sparkSession
    if not n:
        return spark.createDataFrame([], INDEX)
    done.foreachPartition(_dropper(folder))
    return spark.read.schema(INDEX).json(f"{folder}/*.idx.json")


def _dropper(folder: str):
    def run(rows):
        fs, at = file_system(folder)
        for r in rows:
            if fs.get_file_info(f"{at}/{r.name}{RAW}").is_file:
                fs.delete_file(f"{at}/{r.name}{RAW}")

    return run


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, intact: of every record, read by its offset.

    A response's length and digest are its payload's own; a revisit's are what its heads say. intact: a
    response's digest is the one in its head.
    """
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, intact boolean"

    def run(batches):
        import pyarrow as pa

        fs, at = file_system(folder)
        name, f = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["file"] != name:
                    if f is not None:
                        f.close()
                    name, f = r["file"], fs.open_input_file(f"{at}/{r['file']}")
                f.seek(r["offset"])
                data = zlib.decompress(f.read(r["length"]), 31)
                head, _, body = data.partition(b"\r\n\r\n")
                w = headers(head)
                http, _, payload = body[: int(w["content-length"])].partition(b"\r\n\r\n")
                said = w["warc-payload-digest"].partition(":")[2]
                num = lambda k, w=w: int(w[k]) if w.get(k) else None
                if w["warc-type"] == "response":
                    size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                else:
                    size, digest = int(headers(http)["content-length"]), said
                out.append((num("x-page-id"), w["warc-target-uri"], size, digest, w["warc-type"], num("x-refers-to-page"), digest == said))
            cols = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"])

    return index.select("file", "offset", "length").mapInArrow(run, schema)


def archive(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages into folder, normalises the archives, and reads them back."""
    return read_archives(normalise_all(write_archives(decide(pages), folder), folder), folder)
