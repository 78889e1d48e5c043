"""Web archives: a Python data source that reads and writes WARC files (operator 5).

Reading plans one task for each file, or for several small ones. A record's headers are read first; predicates on the record type and
other header columns are pushed down into the reader, and a record that they turn away, or whose payload isn't a
column of the wanted schema, is skipped without its body being inflated: each record is a gzip member of its own whose
header carries the member's length (the sl field of the WARC format's annex on compression). Members without it are inflated to their end.

Writing gives each record in its own member, in files of at most about FILE_BYTES. A task writes under names of its own attempt and
the driver keeps only the files of attempts that were committed, so lost executors and repeated tasks leave no records behind.

Null payloads count as empty. Line breaks and other control characters in an address are percent-encoded, so that they can't end its header. Rows that repeat the
smallest id of a payload are all responses, and so is a row without an id; both are kept. An empty table writes no files, and a folder without files reads as no rows. Columns other than the data
source's own are ignored. Payloads of any length are kept whole.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .common import written

FILE_BYTES = 64 << 20
TASK_BYTES = 32 << 20
SCHEMA = "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, page_id long, payload_bytes long, payload binary"
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
}
_CONTROL = re.compile(r"[\x00-\x1f\x7f\x85\u2028\u2029]")
DATE = "2024-01-01T00:00:00Z"  # crawled pages carry no time of their own here


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark gives it: a path without one lies in Spark's default file system, which needn't be the machine's own."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def _files(path: str):
    """The file system of a path and the path in it. Python workers don't know Spark's default file system, so a path without a scheme is the machine's own: qualified() resolves it as Spark does."""
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(record: bytes) -> bytes:
    """A gzip member whose extra field sl holds its own length and the record's."""
    packer = zlib.compressobj(3, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = 12 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record(page_id: int, uri: str, kind: str, payload: bytes, sha1: str, size: int, refers_to: int | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP headers, and so the payload's length, but no payload."""
    uri = _CONTROL.sub(lambda m: "".join(f"%{b:02X}" for b in m.group().encode("utf-8")), uri)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcSource(DataSource):
    """spark.read.format("warc").load(folder) and df.write.format("warc").save(folder)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], schema, overwrite)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.columns = path, schema.names
        self.equal: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equality and membership of header columns; gives the others back."""
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in (*HEADERS, "page_id"):
                self.equal.append((f.attribute[0], tuple(f.value) if isinstance(f, In) else (f.value,)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        system, path = _files(self.path)
        if system.get_file_info(path).type == fs.FileType.NotFound:
            return [Files([])]  # Spark reads no partitions as one that is None
        found = sorted((i.path, i.size) for i in system.get_file_info(fs.FileSelector(path, recursive=True)) if i.path.endswith(".warc.gz") and "/_" not in i.path)
        out, size = [], TASK_BYTES
        for name, n in found:
            if size + n > TASK_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(name)
            size += n
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _files(self.path)
        with_payload = "payload" in self.columns
        schema = pa.schema([(c, {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}.get(c, pa.string())) for c in self.columns])
        rows: list[dict] = []
        size = 0
        for path in partition.paths:
            with system.open_input_file(path) as f:
                for row in records(f, self.accepts, with_payload):
                    rows.append(row)
                    size += len(row.get("payload") or b"") + 300
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def accepts(self, row: dict) -> bool:
        return all(row[c] in values for c, values in self.equal)


def records(f, accepts, with_payload: bool) -> Iterator[dict]:
    """Rows of a file's records: headers first, the rest of a member only if the record is wanted with its payload."""
    at, end = 0, f.size()
    while at < end:
        data = f.read_at(min(8192, end - at), at)
        flags, begin, size = data[3], 10, 0
        if flags & 4:
            extra = struct.unpack_from("<H", data, 10)[0]
            begin = 12 + extra
            field = 12
            while field + 4 <= begin:
                if data[field : field + 2] == b"sl":
                    size = struct.unpack_from("<I", data, field + 4)[0]
                field += 4 + struct.unpack_from("<H", data, field + 2)[0]
        for bit in (8, 16):  # a name and a comment
            if flags & bit:
                begin = data.index(b"\0", begin) + 1
        begin += 2 * bool(flags & 2)
        inflate = zlib.decompressobj(-15)
        text, position = inflate.decompress(data[begin:], 4096), at + len(data)
        while text.count(b"\r\n\r\n") < 2 and not inflate.eof:
            more = inflate.unconsumed_tail
            if not more:
                more = f.read_at(min(8192, end - position), position)
                position += len(more)
                if not more:
                    break
            text += inflate.decompress(more, 4096)
        head, _, block = text.partition(b"\r\n\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
        row: dict = {c: fields.get(h.lower()) for c, h in HEADERS.items()}
        row["page_id"] = _page(row["record_id"])
        http = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in block.partition(b"\r\n\r\n")[0].decode("latin-1").split("\r\n")[1:])}
        row["payload_bytes"] = int(http["content-length"]) if "content-length" in http else None
        row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:") or None
        wanted = accepts(row)
        if not size or wanted and with_payload:
            rest, parts = inflate.unconsumed_tail, [text]
            while not inflate.eof:
                if not rest:
                    rest = f.read_at(min(1 << 20, end - position), position)
                    position += len(rest)
                    if not rest:
                        break
                parts.append(inflate.decompress(rest))
                rest = inflate.unconsumed_tail
            size = size or position - len(inflate.unused_data) + 8 - at
            if wanted and with_payload:
                whole = b"".join(parts)
                body = whole[len(head) + 4 : len(head) + 4 + int(fields["content-length"])]
                row["payload"] = body.partition(b"\r\n\r\n")[2] if row["record_type"] != "revisit" else None
        if wanted:
            yield row
        at += size


def _page(record_id: str | None) -> int | None:
    name = (record_id or "").strip("<>").removeprefix("urn:page:")
    return int(name) if name.lstrip("-").isdigit() else None


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceWriter):
    """Rows need page_id, url, payload, record_type, refers_to (a page_id or null)."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.columns, self.overwrite = path, schema.names, overwrite

    def write(self, iterator: Iterator) -> Written:
        import uuid

        system, path = _files(self.path)
        system.create_dir(f"{path}/_attempts", recursive=True)
        names: list[str] = []
        out, size = io.BytesIO(), 0

        def close() -> None:
            nonlocal out, size
            names.append(f"{uuid.uuid4().hex}.warc.gz")
            with system.open_output_stream(f"{path}/_attempts/{names[-1]}", compression=None) as f:
                f.write(out.getvalue())
            out, size = io.BytesIO(), 0

        at = {c: i for i, c in enumerate(self.columns)}
        for row in iterator:
            payload = bytes(row[at["payload"]] or b"")
            size += out.write(member(record(row[at["page_id"]], row[at["url"]] or "", row[at["record_type"]], payload, digest(payload), len(payload), row[at["refers_to"]])))
            if size >= FILE_BYTES:
                close()
        if size:
            close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = _files(self.path)
        if self.overwrite:
            from pyarrow import fs

            if system.get_file_info(path).type != fs.FileType.NotFound:
                for i in system.get_file_info(fs.FileSelector(path)):
                    if i.path.endswith(".warc.gz"):
                        system.delete_file(i.path)
        for m in messages:
            for name in m.names if m else []:
                system.move(f"{path}/_attempts/{name}", f"{path}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        system, path = _files(self.path)
        if system.get_file_info(f"{path}/_attempts").type != fs.FileType.NotFound:
            system.delete_dir(f"{path}/_attempts")


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets filters reach Python readers."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload, record_type, refers_to: of equal payloads of at least least_bytes, the smallest page_id is the response.

    Equality is that of length and SHA-256. Digests alone are compared, so no payload travels by a key that many rows share; what revisits another is joined back by its page_id and digest.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload")).withColumn("hash", F.sha2("payload", 256))
    digests = written(rows.select("page_id", "hash", "size").filter(F.col("size") >= least_bytes), "digests")
    firsts = digests.groupBy("hash", "size").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
    again = digests.join(firsts, ["hash", "size"]).filter("first < page_id").select("page_id", "hash", "first").distinct()
    again = written(again, "revisits")
    return rows.join(again, ["page_id", "hash"], "left").select(
        "page_id", "url", "payload", F.when(F.col("first").isNotNull(), "revisit").otherwise("response").alias("record_type"), F.col("first").alias("refers_to")
    )


def archived(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Writes pages to archives in path and reads their records back, without payloads."""
    spark = pages.sparkSession
    register(spark)
    path = qualified(spark, path)
    with_revisits(pages, least_bytes).write.format("warc").mode("append").save(path)
    found = spark.read.format("warc").schema(SCHEMA.removesuffix(", payload binary")).load(path)
    return found.filter(F.col("record_type").isin("response", "revisit")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.regexp_extract("refers_to", r"urn:page:(-?\d+)", 1).try_cast("long").alias("refers_to")
    )
