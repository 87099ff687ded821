"""Landing readers and sinks.

Files are read once landed (downloads are not part of the library).  All
readers return lazy DataFrames: column pruning reaches the CSV / Parquet
scan, the period of a yearly file comes from the file path metadata, and
zipped CSVs are unpacked one member per task.
"""

from __future__ import annotations

import csv
import hashlib
import io
import itertools
import json
import os
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.session import cut_lineage, ensure_checkpoint_dir, ship_package


# ------------------------------------------------------------ S01 / S02
def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               key: str | Sequence[str] | None = None, fmt: str = "csv", sep: str = ",",
               null_value: str = "") -> DataFrame:
    """Delimited (or Parquet) table with a header.

    Without a schema, types are inferred, except the ``key`` columns which
    stay text (so '01001' keeps its leading zero): the inferred schema is
    taken and the keys overridden before the real read.
    """
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    reader = spark.read.option("header", True).option("sep", sep).option("nullValue", null_value)
    if schema is None:
        inferred = reader.option("inferSchema", True).csv(path).schema
        keys = {key} if isinstance(key, str) else set(key or [])
        schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in keys
                                             else f.dataType, True) for f in inferred.fields])
    return reader.schema(schema).csv(path)


# ------------------------------------------------------------------ S03
def read_bulk(spark: SparkSession, path: str, cols: Sequence[str], sep: str = "|",
              key_col: str = "GEO_ID", key_prefix: str | None = "0500000US",
              key_len: int = 5) -> DataFrame:
    """Pipe-delimited bulk table: only ``cols`` (+ key) are parsed, rows
    whose key starts with ``key_prefix`` are kept, ``geoid`` = last
    ``key_len`` characters, values coerced leniently."""
    from panelspark.functions.keys import right_chars, starts_with
    from panelspark.functions.numbers import to_number
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    df = df.select(key_col, *cols)
    if key_prefix:
        df = df.where(starts_with(key_col, key_prefix))
    return df.select(key_col, right_chars(key_col, key_len).alias("geoid"),
                     *[to_number(c).alias(c) for c in cols])


# ------------------------------------------------------------------ S04
_MEMBER = "path string, member string, method int, size long, crc long, packed binary"
_CHUNK = 1 << 20


def _members(batches):
    """One row per CSV member of each archive: what its directory says, and its packed bytes."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            path, data = path.as_py(), content.as_buffer()
            try:
                listed = sorted((m for m in zipfile.ZipFile(pa.BufferReader(data)).infolist()
                                 if m.filename.lower().endswith(".csv")), key=lambda m: m.filename)
            except zipfile.BadZipFile as e:
                raise ValueError(f"{path}: {e}") from e
            if not listed:
                raise ValueError(f"{path}: no CSV in the archive")
            for m in listed:
                if m.flag_bits & 1 or m.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                    raise ValueError(f"{path}, {m.filename}: encrypted or packed by another method")
                name, extra = struct.unpack("<HH", data.slice(m.header_offset + 26, 4).to_pybytes())
                packed = data.slice(m.header_offset + 30 + name + extra, m.compress_size)
                yield pa.record_batch([pa.array([path]), pa.array([m.filename]), pa.array([m.compress_type], pa.int32()),
                                       pa.array([m.file_size], pa.int64()), pa.array([m.CRC], pa.int64()),
                                       pa.array([packed.to_pybytes()], pa.binary())],
                                      names=["path", "member", "method", "size", "crc", "packed"])


class _Unpacked(io.RawIOBase):
    """A member's bytes, unpacked piece by piece; its stored size and checksum must hold at the end."""

    def __init__(self, packed, method: int, size: int, crc: int):
        self.packed, self.at, self.size, self.crc = packed, 0, size, crc
        self.inflate = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
        self.held, self.seen, self.sum = b"", 0, 0

    def readable(self):
        return True

    def readinto(self, buffer):
        while not self.held:
            more = self.inflate.unconsumed_tail if self.inflate else b""
            if not more:
                more = bytes(self.packed[self.at:self.at + _CHUNK])
                self.at += len(more)
            self.held = self.inflate.decompress(more, _CHUNK) if self.inflate else more
            if not self.held and not more:
                if (self.seen, self.sum) != (self.size, self.crc):
                    raise ValueError(f"damaged: {self.seen} bytes of {self.size}")
                return 0
        part, self.held = self.held[:len(buffer)], self.held[len(buffer):]
        buffer[:len(part)] = part
        self.seen, self.sum = self.seen + len(part), zlib.crc32(part, self.sum)
        return len(part)


def read_zipped_csv(spark: SparkSession, glob: str, schema: T.StructType,
                    path_col: str | None = "source_file") -> DataFrame:
    """CSV members of zip archives, all of them.

    ``binaryFile`` gives one row per archive; a task cuts its archives into their
    members by the central directory, still packed, and the members are dealt
    over tasks by name, so one large archive is unpacked and read by many.  A member is
    unpacked piece by piece, checked against its stored size and checksum, and its
    fields are found by header name, so their order may differ; Spark then casts them,
    and what does not parse is NULL.  An archive without CSV, a damaged member, or one
    without some of the schema's columns fails the job and is named."""
    fields = [f.name for f in schema.fields]
    raw_schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(fields))]
                              + [T.StructField("path", T.StringType())])

    def rows_of(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                path, member, method, size, crc = (batch.column(c)[k].as_py() for c in range(5))
                raw = _Unpacked(memoryview(batch.column(5)[k].as_buffer()).cast("B"), method, size, crc)
                try:
                    lines = csv.DictReader(io.TextIOWrapper(io.BufferedReader(raw, _CHUNK), "utf-8-sig", newline=""))
                    if lost := sorted(set(fields) - set(lines.fieldnames or ())):
                        raise ValueError(f"without the columns {lost}")
                    while part := list(itertools.islice(lines, 20_000)):
                        columns = [pa.array([r[f] or None for r in part], pa.string()) for f in fields]
                        yield pa.record_batch([*columns, pa.array([path] * len(part))], names=raw_schema.names)
                except (ValueError, zlib.error) as e:
                    raise ValueError(f"{path}, {member}: {e}") from e

    ship_package(spark)
    archives = spark.read.format("binaryFile").load(glob).select("path", "content")
    members = archives.mapInArrow(_members, _MEMBER).repartition("path", "member")
    raw = members.mapInArrow(rows_of, raw_schema)
    typed = [F.col(f"c{k}").try_cast(f.dataType).alias(f.name) for k, f in enumerate(schema.fields)]
    return raw.select(*typed, *([F.col("path").alias(path_col)] if path_col else []))


def write_zipped_csv(df: DataFrame, folder: str, member_rows: int = 20_000) -> DataFrame:
    """Every task's rows as one zip archive of CSV members of ``member_rows`` rows in
    ``folder`` (a path that executors can write); (archive, members, rows) of each."""
    header = df.columns

    def write(batches):
        fs, path = pa.fs.FileSystem.from_uri(folder) if "://" in folder else (
            pa.fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/"))
        fs.create_dir(path, recursive=True)
        name, held, members, rows = f"part-{uuid.uuid4().hex}.zip", [], 0, 0
        with fs.open_output_stream(f"{path}/{name}", compression=None) as f, \
                zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as archive:
            for batch in itertools.chain(batches, [None]):
                held += batch.to_pylist() if batch is not None else []
                while len(held) >= member_rows or batch is None and (held or not members):
                    text = io.StringIO(newline="")
                    out = csv.DictWriter(text, header)
                    out.writeheader()
                    out.writerows(held[:member_rows])
                    archive.writestr(f"rows-{members}.csv", text.getvalue())
                    members, rows, held = members + 1, rows + len(held[:member_rows]), held[member_rows:]
        yield pa.record_batch([pa.array([name]), pa.array([members], pa.int32()), pa.array([rows], pa.int64())],
                              names=["archive", "members", "rows"])

    ship_package(df.sparkSession)
    text = [F.col(f"`{c}`").cast("string").alias(c) for c in header]
    return cut_lineage(df.select(*text).mapInArrow(write, "archive string, members int, rows long"))


# ------------------------------------------------------------------ S05
def json_rows_to_df(df: DataFrame, payload: str, fields: Sequence[str],
                    keep: Sequence[str] = ()) -> DataFrame:
    """Header-row JSON (array of arrays, row 0 = column names) → rows.

    Payloads with at most one row (header only) give nothing; fields are
    looked up by header name, so column order may differ per payload."""
    arr = F.from_json(F.col(payload), "array<array<string>>")
    d = df.select(*keep, arr.alias("_a")).where(F.size("_a") > 1)
    d = d.select(*keep, F.col("_a")[0].alias("_h"), F.posexplode("_a").alias("_pos", "_row"))
    d = d.where(F.col("_pos") > 0)
    d = d.select(*keep, F.map_from_arrays("_h", "_row").alias("_m"))
    return d.select(*keep, *[F.col("_m")[f].alias(f) for f in fields])


# ------------------------------------------------------------------ S06
def read_json_pages(spark: SparkSession, path: str, schema: T.StructType | None = None
                    ) -> DataFrame:
    """Paged JSON record sets (each file a JSON array of objects) read as
    one table; headers lower-cased (S10)."""
    from panelspark.operators.clean import normalise_columns
    r = spark.read.option("multiLine", True)
    df = r.schema(schema).json(path) if schema else r.json(path)
    return normalise_columns(df)


def missing_pages(pages: DataFrame, page_col: str = "page") -> DataFrame:
    """(page) of the numbers from 0 to the last page of which no page was landed."""
    have = pages.select(F.col(page_col).cast("long").alias("page")).distinct()
    last = have.agg(F.max("page").alias("last")).where("last is not null")
    return last.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("page")).join(
        have, "page", "left_anti")


# ------------------------------------------------------------------ S08
def read_years(spark: SparkSession, path: str, period_col: str = "year",
               pattern: str = r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", on: str = "file_name",
               fmt: str = "csv", **kw) -> DataFrame:
    """Yearly files read together; the period comes from the file name (or
    the full ``file_path``) through the file metadata column."""
    df = read_table(spark, path, fmt=fmt, **kw)
    fname = F.regexp_extract(F.col(f"_metadata.{on}"), pattern, 1)
    return df.withColumn(period_col, F.nullif(fname, F.lit("")).try_cast("int"))


# ------------------------------------------------------------------ S11
def write_table(df: DataFrame, path: str, partition_by: str | Sequence[str] | None = "year",
                fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Table sink, partitioned by period (partition pruning for later
    reads of one year)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


# ------------------------------------------------------------------ S13
def stage_root(spark: SparkSession) -> str:
    """Shared folder for stage tables: under the cluster's checkpoint dir."""
    return os.path.join(ensure_checkpoint_dir(spark), "stages")


class _Files:
    """The Hadoop file system of a path, as Spark itself sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self.gateway, self.jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def read(self, path: str) -> str | None:
        if not self.fs.exists(self.path(path)):
            return None
        stream = self.fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """All of ``text`` at once: written beside, then renamed over what was there."""
        beside = self.path(f"{path}.{uuid.uuid4().hex}")
        stream = self.fs.create(beside)
        stream.write(bytearray(text.encode()))
        stream.close()
        over = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(over, 1)
        options[0] = over.OVERWRITE
        target = self.path(path)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
        context.rename(beside, target, options)

    def stamp(self, path: str) -> list:
        status = self.fs.getFileStatus(self.path(path))
        return [path, status.getLen(), status.getModificationTime()]


def fingerprint(df: DataFrame) -> str | None:
    """A digest of the frame's plan and of the name, size and time of every file it reads;
    None where that does not tell all: rows of this session, Python functions, subqueries."""
    plan = df._jdf.queryExecution().analyzed()
    leaves = plan.collectLeaves()
    text = plan.canonicalized().toString()
    if re.search("python|pandas|arrow|subquery", text, re.IGNORECASE) or any(
            leaves.apply(k).nodeName() not in ("LogicalRelation", "OneRowRelation", "Range") for k in range(leaves.size())):
        return None
    stamps = [_Files(df.sparkSession, f).stamp(f) for f in sorted(df.inputFiles())]
    return hashlib.sha256(json.dumps([text, stamps]).encode()).hexdigest()


def materialise(spark: SparkSession, name: str, build: Callable[[], DataFrame],
                force: bool = False, root: str | None = None,
                partition_by: str | Sequence[str] | None = None) -> DataFrame:
    """Stage table with reuse.  The table is written into a folder of its own, and only
    then a manifest that names it, with the fingerprint of plan and inputs, replaces the
    last one by a single rename; readers see the old stage or the new one, never half of
    one.  The table is reused while the fingerprint is the same (unless ``force``): a
    rewritten input or another plan builds it anew.  A frame without a fingerprint is
    always built.  ``build`` returns a lazy frame and is called each time, for its plan.
    The folder that a new one replaces stays for its readers and goes at the next
    replacement."""
    path = os.path.join(root or stage_root(spark), name)
    manifest, files = f"{path}/manifest.json", _Files(spark, path)
    df = build()
    mark = fingerprint(df)
    known = json.loads(files.read(manifest) or "{}")
    if force or mark is None or known.get("fingerprint") != mark or known.get("partition_by") != partition_by:
        table = f"table-{uuid.uuid4().hex}"
        write_table(df, f"{path}/{table}", partition_by)
        files.write(manifest, json.dumps({"fingerprint": mark, "partition_by": partition_by, "table": table,
                                          "before": known.get("table")}))
        if known.get("before"):
            files.fs.delete(files.path(f"{path}/{known['before']}"), True)
        known = {"table": table}
    return spark.read.parquet(f"{path}/{known['table']}")


# ------------------------------------------------------------------ S14
def load_or_skip(loaders: Mapping[str, Callable[[], DataFrame]],
                 required: Sequence[str] = ()) -> tuple[list[tuple[str, DataFrame]], list[tuple[str, str]]]:
    """Load each source; skip (and report) the ones that fail, lack a
    required column or are empty."""
    good, skipped = [], []
    for name, load in loaders.items():
        try:
            df = load()
        except Exception as exc:  # noqa: BLE001 - a failed source is skipped, not fatal
            skipped.append((name, f"failed: {type(exc).__name__}: {exc}"))
            continue
        missing = [c for c in required if c not in df.columns]
        if missing:
            skipped.append((name, f"missing columns {missing}"))
        elif df.isEmpty():
            skipped.append((name, "no rows"))
        else:
            good.append((name, df))
    return good, skipped
