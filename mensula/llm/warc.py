"""WARC archives as a Spark data source, read and written.

    warc.register(spark)
    records.write.format("warc").mode("append").save(folder)
    spark.read.format("warc").option("payload", "false").load(folder).where("record_type = 'revisit'")

Reading plans partitions over whole files, several small ones to a partition. Conditions on the
record type and other header columns are pushed down: the header of a record is parsed first, and
the payload of a record that does not pass is skipped by its length (a seek in a plain file), not
read or decoded. With `payload=false` no payload is.

Writing rolls over to a new file at `file_mb`. Each task attempt writes files of its own name, and
only the commit lists the files of the attempts that count in a manifest. What a lost or repeated
attempt leaves is never read. Files are reached through `pyarrow.fs`, so a folder can be
in any store it knows by URI; all executors must reach it.
"""

from __future__ import annotations

import gzip
import io
import json
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)

from mensula.sizing import scratch_path, small_side

SCHEMA = (
    "record_id string, record_type string, target_uri string, record_date string, payload_digest string, payload_length long, "
    "refers_to string, headers map<string,string>, payload binary"
)
MANIFEST = "_manifest-"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
NO_DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20

_TESTS = {
    EqualTo: lambda v, f: v == f.value, In: lambda v, f: v in f.value, IsNull: lambda v, f: v is None, IsNotNull: lambda v, f: v is not None,
    GreaterThan: lambda v, f: v > f.value, GreaterThanOrEqual: lambda v, f: v >= f.value,
    LessThan: lambda v, f: v < f.value, LessThanOrEqual: lambda v, f: v <= f.value,
    StringStartsWith: lambda v, f: v.startswith(f.value), StringEndsWith: lambda v, f: v.endswith(f.value), StringContains: lambda v, f: f.value in v,
}
_HEADER_COLUMNS = {"record_id", "record_type", "target_uri", "record_date", "payload_digest", "payload_length", "refers_to"}


def _passes(row: dict, filters: list[Filter]) -> bool:
    for f in filters:
        value = row[f.attribute[0]]
        if value is None and not isinstance(f, IsNull) or not _TESTS[type(f)](value, f):
            return False
    return True


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


# --- one record ------------------------------------------------------------------------------------


def _clean(value: str) -> str:
    """A header value on one line: control characters and spaces are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), value)


def record(row: dict) -> bytes:
    """Bytes of one record. A revisit has no block; its digest and length are those of the full payload."""
    payload = b"" if row["payload"] is None else row["payload"]
    kind = row["record_type"]
    block = HEAD + payload if kind == "response" else b"" if kind == "revisit" else payload
    lines = {
        "WARC-Type": kind, "WARC-Record-ID": row["record_id"], "WARC-Date": row.get("record_date") or NO_DATE,
        "WARC-Target-URI": row.get("target_uri"), "WARC-Refers-To": row.get("refers_to"),
        "WARC-Profile": REVISIT_PROFILE if kind == "revisit" else None,
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}" if row.get("payload_digest") else None,
        "X-Payload-Length": str(row["payload_length"]) if row.get("payload_length") is not None else None,
        "Content-Type": "application/http; msgtype=response" if kind in ("response", "revisit") else "application/octet-stream",
        **dict(row.get("headers") or []), "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v if k == 'Content-Type' else _clean(v)}\r\n" for k, v in lines.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _headers(stream) -> dict[str, str] | None:
    """Header lines of the next record; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
    headers: dict[str, str] = {}
    last = None
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and last:
            headers[last] += " " + text.strip()
        else:
            last, _, value = text.partition(":")
            headers[last] = value.strip()
    return headers


def records(stream, filters: list[Filter], payload: bool) -> Iterator[dict]:
    """Records of an open file that pass, as rows of `SCHEMA`."""
    while (headers := _headers(stream)) is not None:
        named = {k.lower(): v for k, v in headers.items()}
        size = int(named.get("content-length", 0))
        http = named.get("content-type", "").startswith("application/http") and size > 0
        digest = named.get("warc-payload-digest")
        known = named.get("x-payload-length")
        row = {
            "record_id": named.get("warc-record-id"), "record_type": named.get("warc-type"), "target_uri": named.get("warc-target-uri"),
            "record_date": named.get("warc-date"), "payload_digest": digest and digest.partition(":")[2], "refers_to": named.get("warc-refers-to"),
            "payload_length": int(known) if known else size, "headers": list(headers.items()), "payload": None,
        }
        # Only the length may need a look into the block, where the head of the message is.
        head = 0
        by_length = any(f.attribute[0] == "payload_length" for f in filters)
        wanted = _passes(row, [f for f in filters if f.attribute[0] != "payload_length"])
        if wanted and http and (payload or not known):
            while head < size:
                line = stream.readline(size - head)
                head += len(line)
                if line in (b"\r\n", b"\n", b""):
                    break
            if not known:
                row["payload_length"] = size - head
        if wanted and by_length:
            wanted = _passes(row, filters)
        if wanted and payload and row["record_type"] != "revisit":
            row["payload"] = stream.read(size - head)
        else:
            stream.seek(size - head, io.SEEK_CUR)
        if wanted:
            yield row


# --- data source -----------------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    files: tuple[tuple[str, int], ...]


class Reader(DataSourceReader):
    def __init__(self, path: str, payload: bool, partition_mb: float, schema):
        self.path, self.payload, self.target, self.schema = path, payload, int(partition_mb * (1 << 20)), schema
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in _HEADER_COLUMNS:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        store, root = _open(self.path)
        found = {i.path: i.size for i in store.get_file_info(fs.FileSelector(root, recursive=True)) if i.is_file}
        listed = [p for p in found if posixpath.basename(p).startswith(MANIFEST)]
        if listed:
            # A manifest names files of its own folder, which may lie below the one that is read.
            paths = []
            for p in listed:
                with store.open_input_stream(p) as manifest:
                    paths += [posixpath.join(posixpath.dirname(p), n) for n in json.loads(manifest.read())["files"]]
            files = [(path, found[path]) for path in paths]
        else:
            files = [(p, n) for p, n in found.items() if p.endswith((".warc", ".warc.gz"))]
        plan, held, size = [], [], 0
        for file in sorted(files):
            if held and size + file[1] > self.target:
                plan.append(Files(tuple(held)))
                held, size = [], 0
            held.append(file)
            size += file[1]
        return [*plan, Files(tuple(held))]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        rows, size = [], 0
        for path, _ in partition.files:
            with store.open_input_file(path) as raw:
                buffered = io.BufferedReader(raw, 1 << 16)
                stream = gzip.GzipFile(fileobj=buffered) if path.endswith(".gz") else buffered
                for row in records(stream, self.filters, self.payload):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 512
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=self.schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=self.schema)


@dataclass
class Written(WriterCommitMessage):
    files: tuple[str, ...]


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, compressed: bool, file_mb: float):
        self.path, self.compressed, self.target = path, compressed, int(file_mb * (1 << 20))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in batches:
                for s in range(0, batch.num_rows, 256):
                    for row in batch.slice(s, 256).to_pylist():
                        data = record(row)
                        if self.compressed:  # a member of its own for each record
                            data = gzip.compress(data, 1, mtime=0)
                        if out is not None and size + len(data) > self.target:
                            out.close()
                            out = None
                        if out is None:
                            names.append(f"{uuid.uuid4().hex}.warc{'.gz' if self.compressed else ''}")
                            out, size = store.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                        out.write(data)
                        size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(tuple(names))

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        files = sorted(n for m in messages if m is not None for n in m.files)
        with store.open_output_stream(f"{root}/{MANIFEST}{uuid.uuid4().hex}.json") as manifest:
            manifest.write(json.dumps({"files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files without a manifest are never read; nothing has to be undone."""


class WarcSource(DataSource):
    """`path`; reading: `payload` (true), `partition_mb` (64); writing: `compressed` (false), `file_mb` (64)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def _flag(self, name: str, default: str) -> bool:
        return str(self.options.get(name, default)).lower() == "true"

    def reader(self, schema) -> Reader:
        from pyspark.sql.pandas.types import to_arrow_schema

        return Reader(self.options["path"], self._flag("payload", "true"), float(self.options.get("partition_mb", 64)), to_arrow_schema(schema))

    def writer(self, schema, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("write WARC archives with mode('append')")
        return Writer(self.options["path"], self._flag("compressed", "false"), float(self.options.get("file_mb", 64)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# --- pages -----------------------------------------------------------------------------------------

SMALLEST_REVISITED = 100
_PAGE = "<urn:page:"


def page_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows to write, one per page: the smallest key of equal payloads is the response, the others revisit it.

    Payloads below `SMALLEST_REVISITED` bytes are all responses. A NULL html is an empty payload. Rows that tie on the
    smallest key are all responses; a NULL key is never the smallest, and pages with NULL keys only are all
    responses. Pages of equal payload are told by a count per digest: few are broadcast after
    a check of their size, many are joined by a shuffle that Spark can split.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("string").alias("k"), F.col(key).alias("id"), F.col(url).alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("long")})
    firsts = (
        rows.where(F.col("payload_length") >= SMALLEST_REVISITED).groupBy("payload_digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("payload_digest", "first")
    )
    known = rows.join(small_side(firsts), "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    name = lambda c: F.concat(F.lit(_PAGE), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return known.select(
        name(F.col("k")).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit(None).cast("string").alias("record_date"), "payload_digest", "payload_length", F.when(again, name(F.col("first"))).alias("refers_to"),
        F.lit(None).cast("map<string,string>").alias("headers"), F.when(~again, F.col("payload")).alias("payload"),
    )


def page_of(column: str, kind: str):
    """The key in a record name; NULL for none."""
    return F.nullif(F.regexp_extract(column, f"^{_PAGE}(.*)>$", 1), F.lit("")).cast(kind)


def archive(pages: DataFrame, path: str | None = None, compressed: bool = False, key: str = "page_id") -> DataFrame:
    """Writes the pages to `path` (a new folder in the shared one by default) and gives what is read back from it.

    Responses are read with their payloads, whose length and digest are taken anew; of revisits only the headers are read.
    """
    spark = pages.sparkSession
    register(spark)
    path = path or scratch_path(spark, "warc")
    page_records(pages, key).write.format("warc").option("compressed", str(compressed).lower()).mode("append").save(path)
    read = spark.read.format("warc").option("payload", "true").load(path).where("record_type = 'response'")
    heads = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'revisit'")
    kind = pages.schema[key].dataType.simpleString()
    own = [page_of("record_id", kind).alias(key)]
    more = ["record_type", page_of("refers_to", kind).alias("refers_to"), "target_uri", "payload"]
    return read.select(
        *own, F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"), *more,
    ).unionByName(heads.select(*own, F.col("payload_length").alias("payload_bytes"), "payload_digest", *more))
