"""Sources: id lists, schemas, payloads, archives, object events."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKED = pa.schema([("path", pa.string()), ("entry", pa.string()), ("packed", pa.binary()), ("method", pa.int32()), ("size", pa.int64()), ("crc", pa.int64()), ("error", pa.string())])
UNPACKED = pa.schema([("path", pa.string()), ("entry", pa.string()), ("content", pa.binary()), ("error", pa.string())])
EVENTS = "struct<Records:array<struct<eventSource:string,eventName:string,eventTime:string,s3:struct<bucket:struct<name:string>,object:struct<key:string,size:bigint>>>>>"


def read_id_list(spark: SparkSession, path: str, column: str = "id") -> DataFrame:
    """One id a line; blank lines are skipped."""
    return spark.read.text(path).select(F.trim("value").alias(column)).filter(F.col(column) != "")


SCHEMA_SHAPE = "struct<endpoints:array<struct<endpointId:string,scopeName:string,url:string,ignoredKeys:array<string>,tables:array<struct<tableKey:string,columns:array<struct<columnId:string,columnType:string,maxLength:int>>>>>>>"


def _endpoints(spark: SparkSession, path: str) -> DataFrame:
    docs = spark.read.text(path, wholetext=True).select(F.from_json("value", SCHEMA_SHAPE).endpoints.alias("endpoints"))
    return docs.select(F.col("endpoints").isNull().alias("broken"), F.explode_outer("endpoints").alias("e"))


def load_endpoint_schemas(spark: SparkSession, path: str) -> DataFrame:
    """(endpoint_id, scope, table_key, column_id, kind, max_length, problem) of JSON documents of endpoints, a file each; one that isn't such a document has a row with a problem."""
    tables = _endpoints(spark, path).select("broken", "e.endpointId", "e.scopeName", "e.url", F.explode_outer("e.tables").alias("t"))
    columns = tables.select("broken", "endpointId", "scopeName", "url", "t.tableKey", F.explode_outer("t.columns").alias("c"))
    problem = (
        F.when(F.col("broken"), "not a document of endpoints")
        .when(F.col("endpointId").isNull() | F.col("scopeName").isNull() | F.col("url").isNull(), "endpoint needs id, scope and url")
        .when(F.col("tableKey").isNull(), "table needs a key")
        .when(F.col("c.columnId").isNull() | F.col("c.columnType").isNull(), "column needs id and type")
        .when((F.col("c.columnType") == "STRING") & ~F.coalesce(F.col("c.maxLength").between(1, 1000), F.lit(False)), "text needs a length of 1 to 1000")
    )
    return columns.select(F.col("endpointId").alias("endpoint_id"), F.col("scopeName").alias("scope"), F.col("tableKey").alias("table_key"), F.col("c.columnId").alias("column_id"), F.col("c.columnType").alias("kind"), F.col("c.maxLength").alias("max_length"), problem.alias("problem"))


def load_ignored_keys(spark: SparkSession, path: str) -> DataFrame:
    """(endpoint_id, table_key) of the keys that the documents' endpoints ignore, for ``schema_key_audit``."""
    keys = _endpoints(spark, path).select(F.col("e.endpointId").alias("endpoint_id"), F.explode("e.ignoredKeys").alias("table_key"))
    return keys.filter("endpoint_id is not null and table_key is not null").distinct()


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with health_code, endpoint_id and created_date; the payload stays text."""
    return spark.read.schema("health_code string, endpoint_id string, created_date string, payload string").json(path)


DEFLATED, STORED = 8, 0  # fixed values of the format: methods
LOCAL_HEADER = 30  # bytes before an entry's name


def archive_entries(data: bytes, max_entries: int, max_size: int) -> list[tuple[str, int, int, int, int, int]]:
    """(name, start, packed size, method, size, crc) of an archive's entries, from its directory; ValueError if it is broken or over a limit."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            infos = [i for i in z.infolist() if not i.is_dir()]
    except (zipfile.BadZipFile, NotImplementedError, UnicodeDecodeError, struct.error) as e:
        raise ValueError(str(e)) from e
    if len(infos) > max_entries:
        raise ValueError("too many entries")
    if len({i.filename for i in infos}) < len(infos):
        raise ValueError("repeated entry")
    if any(i.file_size > max_size for i in infos):
        raise ValueError("entry too large")
    out = []
    for i in infos:
        if i.flag_bits & 1 or i.compress_type not in (STORED, DEFLATED):
            raise ValueError(f"{i.filename} can't be read")
        header = data[i.header_offset : i.header_offset + LOCAL_HEADER]
        if len(header) < LOCAL_HEADER or header[:4] != b"PK\x03\x04":
            raise ValueError(f"no entry where {i.filename} should be")
        start = i.header_offset + LOCAL_HEADER + int.from_bytes(header[26:28], "little") + int.from_bytes(header[28:30], "little")
        out.append((i.filename, start, i.compress_size, i.compress_type, i.file_size, i.CRC))
    return out


def inflated(packed: bytes, method: int, size: int, crc: int, max_size: int) -> bytes:
    """An entry's content; ValueError if it is larger than it says or allowed, or isn't what the directory says."""
    if method == DEFLATED:
        stream = zlib.decompressobj(-15)
        try:
            content = stream.decompress(packed, max_size + 1)
        except zlib.error as e:
            raise ValueError(str(e)) from e
    else:
        content = packed
    if len(content) > max_size:
        raise ValueError("entry too large")
    if len(content) != size or zlib.crc32(content) != crc:
        raise ValueError("entry broken")
    return content


BATCH_ROWS, BATCH_BYTES = 1_000, 1 << 22


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, whose third field is bytes or None, in batches of ``BATCH_ROWS`` or about ``BATCH_BYTES``."""
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += len(r[2] or b"")
        if len(held) >= BATCH_ROWS or total >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in held], schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in held], schema)


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def unpacked(path: str, data: bytes, max_entries: int, max_size: int) -> Iterator[tuple]:
    """(path, entry, content, error) of an archive's entries, or one error row. Contents of more than ``BATCH_BYTES`` in all are checked first and then unpacked again, one at a time."""
    try:
        entries = archive_entries(data, max_entries, max_size)
    except ValueError as e:
        yield path, None, None, str(e)
        return
    content = lambda e: inflated(data[e[1] : e[1] + e[2]], *e[3:], max_size)
    keep, contents, errors = sum(e[4] for e in entries) <= BATCH_BYTES, [], []
    for e in entries:
        try:
            got = content(e)
            contents += [got] if keep else []
        except ValueError as error:
            errors.append(str(error))
    if errors:
        yield path, None, None, min(errors)
        return
    for i, e in enumerate(entries):
        yield path, e[0], contents[i] if keep else content(e), None


def expand_archives(spark: SparkSession, glob: str, max_entries: int = 100, max_size: int = 100_000_000, tasks: int | None = None, small: int = 1 << 22) -> DataFrame:
    """(path, entry, content, error): entries of zip files; a file over a limit, with repeated names or broken gives one error row and no entry.

    A file of up to ``small`` bytes is unpacked by the task that reads it, in one pass. Of a larger one that task only reads the directory and cuts it into packed entries; these are dealt to all
    tasks (``tasks``, by default the shuffle partitions), an entry a row, and unpacked there, so a few large archives keep many tasks busy. Large archives of which an entry turns out
    broken or too large while it is unpacked are told by a join on the few paths with an error. A task holds one entry's content at a time, or a batch of small ones.
    Whether there are large files is looked up by their lengths when this is called.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((r for path, data in _values(batches) for r in unpacked(path, data, max_entries, max_size)), UNPACKED)

    def entries(path: str, data: bytes) -> Iterator[tuple]:
        try:
            for name, start, packed, method, size, crc in archive_entries(data, max_entries, max_size):
                yield path, name, data[start : start + packed], method, size, crc, None
        except ValueError as e:
            yield path, None, None, None, None, None, str(e)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((r for path, data in _values(batches) for r in entries(path, data)), PACKED)

    def content(path, entry, packed, method, size, crc, error) -> tuple:
        if error is not None:
            return path, entry, None, error
        try:
            return path, entry, inflated(packed, method, size, crc, max_size), None
        except ValueError as e:
            return path, entry, None, str(e)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((content(*r) for r in _values(batches)), UNPACKED)

    files, kinds = spark.read.format("binaryFile").load(glob), "path string, entry string, content binary, error string"
    out = files.filter(F.col("length") <= small).select("path", "content").mapInArrow(whole, kinds)
    if (files.agg(F.max("length")).first()[0] or 0) <= small:
        return out
    packed = files.filter(F.col("length") > small).select("path", "content").mapInArrow(cut, "path string, entry string, packed binary, method int, size long, crc long, error string")
    dealt = packed.repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "entry")
    rows = dealt.mapInArrow(unpack, kinds)
    failed = rows.filter("error is not null").groupBy("path").agg(F.min("error").alias("error"))
    good = rows.filter("error is null").join(failed.select("path"), "path", "left_anti").select("path", "entry", "content", "error")
    return out.unionByName(good).unionByName(failed.select("path", F.lit(None).cast("string").alias("entry"), F.lit(None).cast("binary").alias("content"), "error"))


def query_upload_rows(rows: DataFrame, assessment: str | None = None, start_ms: int | None = None, end_ms: int | None = None, include_test: bool = False) -> DataFrame:
    """Rows created from start up to but without end."""
    out = rows if include_test else rows.filter(~F.coalesce("is_test", F.lit(False)))
    if assessment is not None:
        out = out.filter(F.col("assessment_guid") == assessment)
    if start_ms is not None:
        out = out.filter(F.col("created_ms") >= start_ms)
    return out if end_ms is None else out.filter(F.col("created_ms") < end_ms)


def read_object_events(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of notification texts, a line each."""
    return spark.readStream.schema("value string").text(folder)
