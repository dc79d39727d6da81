"""Web archives: a data source that reads WARC files, one that writes them (operator 5).

Reading plans one partition per file. Predicates on the record type and on headers are
pushed down: headers are parsed first, and the block of a record that is not wanted, or
whose payload is not asked for, is skipped without being decoded (in plain files without
being read). Files ending in `.gz` may hold one member per record. Paths go through
pyarrow's file systems, so that `file:`, `hdfs:` or `s3:` folders work alike.

Writing gives each task files of its own of about `FILE_BYTES`; the commit lists the files of successful
tasks in a manifest, and reading a folder with a manifest ignores all others, so that a
repeated or speculative task leaves nothing behind that would be read.

Equal payloads of at least `REVISIT_BYTES` are stored once: the record of the smallest page
id is a response, the others are revisits that name it and carry its HTTP header only.

Defined results: a null payload is an empty one; of repeated rows with one id, one may be a
response and the others revisit it; a null id comes last and reads back as null; line breaks in header
values are percent-encoded; an empty table gives an empty archive that reads back as no rows.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

from meetlake.session import shared_folder, staged

REVISIT_BYTES = 100
FILE_BYTES = 128 * 1024 * 1024
BATCH_ROWS, BATCH_BYTES = 512, 8 * 1024 * 1024
#: Pages carry no time of capture; archives of them state this one.
NO_DATE = "1970-01-01T00:00:00Z"
MANIFEST = "manifest.json"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Columns of a record and the WARC header each comes from.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
SCHEMA = (
    "record_type string, record_id string, target_uri string, warc_date string, "
    "payload_digest string, refers_to string, content_length bigint, http_length bigint, "
    "payload binary"
)


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(), path
    )


@dataclass
class WarcFile(InputPartition):
    path: str

    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def _headers(stream: io.BufferedReader) -> dict[str, str]:
    """Header lines up to the empty line; names in lower case, later ones win."""
    found = {}
    while (line := stream.readline().rstrip(b"\r\n")) != b"":
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def records(stream: io.BufferedReader, wanted, payload: bool):
    """(headers, HTTP length, payload) of the records that `wanted(headers)` accepts.

    Without `payload`, and for records not wanted, the block is skipped.
    """
    while True:
        version = stream.readline()
        if not version:
            return
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers = _headers(stream)
        left = int(headers["content-length"])
        if not wanted(headers):
            stream.seek(left, io.SEEK_CUR)
            continue
        http_length, body = None, None
        if headers.get("content-type", "").startswith("application/http"):
            begin = stream.tell()
            stream.readline()
            inner = _headers(stream)
            left -= stream.tell() - begin
            if inner.get("content-length", "").isdigit():
                http_length = int(inner["content-length"])
        if payload:
            body = stream.read(left)
            if len(body) != left:
                raise ValueError("the record ends early")
        else:
            stream.seek(left, io.SEEK_CUR)
        yield headers, http_length, body


class WarcReader(DataSourceReader):
    def __init__(self, schema, options):
        self.names = schema.fieldNames()
        self.path = options["path"]
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Takes equality, membership and prefix tests on header columns."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo | EqualNullSafe) and f.value is not None:
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((column, "in", tuple(v for v in f.value if v is not None)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            else:
                yield f

    def partitions(self):
        fs, path = _opened(self.path)
        files = fs.get_file_info(pafs.FileSelector(path, recursive=True))
        scheme = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else ""
        held = {f.path for f in files if f.type == pafs.FileType.File}
        manifest = f"{path.rstrip('/')}/{MANIFEST}"
        if manifest in held:
            with fs.open_input_stream(manifest) as f:
                named = {f"{path.rstrip('/')}/{n}" for n in json.loads(f.read())}
            held &= named
        found = sorted(p for p in held if p.endswith((".warc", ".warc.gz")))
        return [WarcFile(scheme + p) for p in found] or [WarcFile("")]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for column, kind, value in self.tests:
            got = _value(column, headers)
            if got is None or not (got in value if kind == "in" else got.startswith(value)):
                return False
        return True

    def read(self, partition):
        if not partition.path:
            return
        fs, path = _opened(partition.path)
        payload = "payload" in self.names
        types = {"content_length": pa.int64(), "http_length": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(n, types.get(n, pa.string())) for n in self.names])
        rows, held = [], 0

        def batch():
            columns = [pa.array([r[n] for r in rows], schema.field(n).type) for n in self.names]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        with fs.open_input_file(path) as raw:
            plain = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
            stream = io.BufferedReader(plain, 1024 * 1024)
            for headers, http_length, body in records(stream, self._wanted, payload):
                row = {c: _value(c, headers) for c in HEADERS}
                row |= {"content_length": int(headers["content-length"])}
                row |= {"http_length": http_length, "payload": body}
                rows.append(row)
                held += len(body or b"")
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


def _value(column: str, headers: dict[str, str]) -> str | None:
    value = headers.get(HEADERS[column])
    if value is not None and column in ("record_id", "refers_to"):
        return value.removeprefix("<").removesuffix(">")
    return value


@dataclass
class WrittenFiles(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        fs, path = _opened(self.path)
        fs.create_dir(path, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc")
                    out, size = fs.open_output_stream(f"{path.rstrip('/')}/{names[-1]}"), 0
                data = record(row)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
        return WrittenFiles(names)

    def commit(self, messages):
        fs, path = _opened(self.path)
        fs.create_dir(path, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        with fs.open_output_stream(f"{path.rstrip('/')}/{MANIFEST}") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages):
        fs, path = _opened(self.path)
        for m in messages:
            for n in m.names if m is not None else ():
                fs.delete_file(f"{path.rstrip('/')}/{n}")


class WarcDataSource(DataSource):
    """`warc`: records as rows; `path` is a folder. A schema without `payload` skips payloads."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(schema, dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def _clean(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """One record: HTTP header and payload; of a revisit the HTTP header only."""
    body = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {row['http_length']}"
    block = (http + "\r\n\r\n").encode() + body
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>"]
    lines.append(f"WARC-Date: {row['warc_date']}")
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_clean(row['target_uri'])}")
    if row["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <{row['refers_to']}>", f"WARC-Profile: {IDENTICAL}"]
    lines += [
        f"WARC-Payload-Digest: {row['payload_digest']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def register(spark: SparkSession) -> None:
    """Make `warc` known to a session, with push-down to Python sources on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    schema = SCHEMA if payload else SCHEMA.replace(", payload binary", "")
    return spark.read.format("warc").schema(schema).load(path)


def _urn(page_id) -> F.Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def archived(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> None:
    """Write an archive: a record per row, payloads that repeat as revisits."""
    register(pages.sparkSession)
    body = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("target_uri"),
        body.alias("body"),
        F.sha2(body, 256).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    turn = F.struct(F.col("page_id").isNull().alias("n"), "page_id", "row")
    # One row per payload that repeats: partial aggregation takes the hot ones. It is staged,
    # so that its true size decides whether it goes to the pages or the pages are shuffled.
    firsts = staged(
        rows.filter(F.octet_length("body") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min(turn).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first"),
        "warc-firsts",
    )
    known = rows.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & (F.col("row") != F.col("first.row"))
    again = again & ~((F.octet_length("body") < REVISIT_BYTES))
    known.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        _urn(F.col("page_id")).alias("record_id"),
        "target_uri",
        F.lit(NO_DATE).alias("warc_date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(again, _urn(F.col("first.page_id"))).alias("refers_to"),
        F.octet_length("body").cast("bigint").alias("http_length"),
        F.when(~again, F.col("body")).alias("payload"),
    ).write.format("warc").mode("append").save(path)


def round_trip(pages: DataFrame, page_id: str = "page_id", url="url", html="html") -> DataFrame:
    """Write the archive of all pages to the shared folder and read it back.

    Per page: page_id, payload_bytes, payload_digest, record_type, refers_to. Sizes and
    digests of responses are taken from the payload read; a revisit states those of its response.
    """
    spark = pages.sparkSession
    path = shared_folder(spark, "warc")
    archived(pages, path, page_id, url, html)
    back = read_warc(spark, path)
    stored = F.col("record_type") == "response"
    number = lambda c: F.substring_index(F.col(c), ":", -1).try_cast("bigint")
    stated = F.substring_index("payload_digest", ":", -1)
    return back.select(
        number("record_id").alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("bigint"))
        .otherwise(F.col("http_length"))
        .alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(stated).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


#: The result as DuckDB states it.
SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (
  SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
f AS (
  SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, d.digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
"""
