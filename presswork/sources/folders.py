"""Tables of very many folders: their files are found and read in tasks, the driver lists none."""

from __future__ import annotations

import io
import itertools
import json
import re
from collections.abc import Iterator, Sequence
from functools import partial
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# --- Fixed values: bytes and paths given to Spark at once, rows decoded at once, names of Spark's own.
BATCH_BYTES = 4 << 20
PATHS = 10_000
DECODED_ROWS = 256
SINK_LOG = "_spark_metadata"
LEGACY = {b"org.apache.spark.legacyDateTime", b"org.apache.spark.legacyINT96"}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

PATH = pa.schema([("path", pa.string())])


def open_store(store: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(store)


def find_store(location: str) -> tuple[str, str] | None:
    """URI of the store a folder lies in and the folder's path; None if tasks can't open it themselves."""
    from pyarrow.fs import FileType

    parts = re.match(r"([a-z][a-z0-9+.-]*):(?://([^/]*))?(/.*)$", location)
    if parts is None:
        return None
    store, path = f"{parts[1]}://{parts[2] or ''}/", parts[3]
    try:
        files, base = open_store(store)
        known = files.get_file_info(base.rstrip("/") + path).type == FileType.Directory
    except (pa.ArrowException, OSError):
        return None
    return (store, path) if known else None


def _paths(found: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(found), PATHS):
        yield pa.record_batch([pa.array(found[at : at + PATHS], pa.string())], schema=PATH)


def _visible(files, folder: str) -> list:
    """What lies in a folder, but for names that Spark passes over as well."""
    from pyarrow.fs import FileSelector

    found = files.get_file_info(FileSelector(folder))
    return [x for x in found if not re.match(r"\.|_(?!.*=)", x.base_name)]


def _folders(store: str, column: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The folders of one partition column below each given folder."""
    from pyarrow.fs import FileType

    files, _ = open_store(store)
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            found = _visible(files, folder)
            for x in found:
                if x.type != FileType.Directory or not x.base_name.startswith(f"{column}="):
                    raise ValueError(f"{x.path} is no folder of {column}")
            yield from _paths([x.path for x in found])


def _files(store: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files in each given folder."""
    from pyarrow.fs import FileType

    files, _ = open_store(store)
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            found = _visible(files, folder)
            for x in found:
                if x.type != FileType.File:
                    raise ValueError(f"{x.path} lies below the last partition column")
            yield from _paths([x.path for x in found])


def _logged(store: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files that the given parts of a sink's log name by URI; their first line is a version."""
    files, base = open_store(store)
    for batch in batches:
        for part in batch.column(0).to_pylist():
            found = []
            with io.TextIOWrapper(files.open_input_stream(part), encoding="utf-8") as lines:
                for entry in map(json.loads, itertools.islice(lines, 1, None)):
                    if entry["action"] != "add":
                        raise ValueError(f"{part} says {entry['action']} of {entry['path']}")
                    found.append(base.rstrip("/") + unquote(urlsplit(entry["path"]).path))
                    if len(found) == PATHS:
                        yield from _paths(found)
                        found = []
            yield from _paths(found)


def log_entries(names: Sequence[str]) -> list[str]:
    """The parts of a sink's log that count: the last compacted one and those after it."""
    parts = {n: int(n.partition(".")[0]) for n in names if re.fullmatch(r"\d+(\.compact)?", n)}
    start = max((n for n in parts if n.endswith(".compact")), key=parts.get, default=None)
    return [n for n, at in parts.items() if start is None or n == start or at > parts[start]]


def _decoded(files, path: str, folder: str, schema: pa.Schema, keys: Sequence[str]) -> Iterator[pa.Table]:
    """Rows of one file with the values that its folders' names give; a column it lacks is null."""
    import pyarrow.parquet as pq

    values = dict(x.split("=", 1) for x in path[len(folder) :].strip("/").split("/")[:-1])
    if tuple(values) != tuple(keys):
        raise ValueError(f"{path} does not lie in folders of {', '.join(keys)}")
    with files.open_input_file(path) as source:
        stored = pq.ParquetFile(source, coerce_int96_timestamp_unit="us", buffer_size=1 << 20)
        if LEGACY & set(stored.metadata.metadata or ()):
            raise ValueError(f"{path} has times of the old calendar; read the table without partition_by")
        present = set(stored.schema_arrow.names) - set(keys)
        wanted = [n for n in schema.names if n in present]
        size = sum(stored.metadata.row_group(i).total_byte_size for i in range(stored.num_row_groups))
        rows = min(DECODED_ROWS, max(1, BATCH_BYTES * stored.metadata.num_rows // max(1, size)))
        for part in stored.iter_batches(rows, columns=wanted, use_threads=False):
            columns = []
            for field in schema:
                if field.name in values:
                    value = unquote(values[field.name])
                    columns.append(pa.repeat(pa.scalar(None if value == NO_VALUE else value, field.type), part.num_rows))
                elif field.name in present:
                    columns.append(part.column(field.name).cast(field.type))
                else:
                    columns.append(pa.nulls(part.num_rows, field.type))
            yield pa.Table.from_arrays(columns, schema=schema)


def _rows(
    store: str, folder: str, schema: pa.Schema, keys: Sequence[str], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Rows of the given files, put together to batches of a few megabytes."""
    files, _ = open_store(store)
    held, size = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            for part in _decoded(files, path, folder, schema, keys):
                held.append(part)
                size += part.nbytes
                if size >= BATCH_BYTES:
                    yield from pa.concat_tables(held).combine_chunks().to_batches()
                    held, size = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def read_in_tasks(
    spark: SparkSession,
    store: str,
    path: str,
    log: Sequence[str] | None,
    schema: StructType,
    keys: Sequence[str],
    tasks: int,
) -> DataFrame:
    """Rows of a Parquet table kept in folders of ``keys``, as Spark's own scan gives them.

    Folders are listed level by level in tasks when the rows are computed, and each file is
    read by one task. With ``log``, parts of a stream's sink log, the files it names count.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    folder = open_store(store)[1].rstrip("/") + path.rstrip("/")
    if log is None:
        paths = spark.range(0, 1, 1, 1).select(F.lit(folder).alias("path"))
        for column in keys:
            paths = paths.mapInArrow(partial(_folders, store, column), "path string").repartition(tasks, "path")
        paths = paths.mapInArrow(partial(_files, store), "path string")
    else:
        parts = spark.createDataFrame([(f"{folder}/{SINK_LOG}/{name}",) for name in log], "path string")
        paths = parts.mapInArrow(partial(_logged, store), "path string").repartition(tasks, "path")
    plain = [f for f in schema.fields if f.name not in keys]
    named = [f for k in keys for f in schema.fields if f.name == k]
    read = StructType([StructField(f.name, f.dataType) for f in plain] + [StructField(f.name, StringType()) for f in named])
    arrow = to_arrow_schema(read)
    rows = paths.mapInArrow(partial(_rows, store, folder, arrow, tuple(keys)), read)
    return rows.select(*[f.name for f in plain], *[F.col(f.name).cast(f.dataType) for f in named])
