"""Arrow IPC files as a Spark data source: ``df.write.format("arrow_ipc")``.

Spark has no such format built in. Batches arrive as Arrow from the JVM and are
written as they are, under the same ``split=<value>/`` layout as the Parquet
sink. Options: ``path``; ``maxRecordsPerFile`` (write); ``partitionBy`` (write,
default ``split``); ``only`` (read, JSON: partition column to the values to read); ``files``
(read, JSON: the files to read, as ``_path`` gives them, in place of all under ``path``). A
``_path`` column in the schema of a read is the file path.
"""

from __future__ import annotations

import json
import posixpath
import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StringType, StructType

STAGING = "_staging"
FORMAT = "arrow_ipc"


def _filesystem(path: str):
    """File system and path within it; anything Arrow knows by URI, else local."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _data_files(filesystem, root: str) -> list[str]:
    from pyarrow import fs

    found = filesystem.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    inside = len(root.rstrip("/")) + 1
    return sorted(
        f.path
        for f in found
        if f.is_file
        and f.path.endswith(".arrow")
        and not any(part.startswith(("_", ".")) for part in f.path[inside:].split("/"))
    )


def _partition_values(path: str) -> dict[str, str | None]:
    """Values of the ``name=value`` folders of a path."""
    pairs = [part.partition("=") for part in path.split("/") if "=" in part]
    return {
        name: None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value)
        for name, _, value in pairs
    }


def _wanted(path: str, only: dict[str, list]) -> bool:
    values = _partition_values(path)
    return all(name not in values or values[name] in few for name, few in only.items())


@dataclass
class StagedFiles(WriterCommitMessage):
    staging: str = ""
    names: list[str] = field(default_factory=list)


class ArrowIpcWriter(DataSourceArrowWriter):
    """Tasks write into a directory of their own attempt; ``commit`` moves the
    files of the attempts that counted. A lost or repeated task leaves nothing
    behind in the result."""

    def __init__(self, options, overwrite: bool):
        self.path = options["path"]
        self.rows_per_file = int(options.get("maxrecordsperfile", 100_000))
        self.by = options.get("partitionby", "split")
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex  # tasks get a copy; other jobs have a staging of their own
        if self.rows_per_file < 1:
            raise ValueError("maxRecordsPerFile must be at least 1")

    def write(self, iterator: Iterator) -> StagedFiles:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        filesystem, root = _filesystem(self.path)
        task = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        staged = StagedFiles(posixpath.join(root, STAGING, self.job, task))
        opened: dict[str, tuple] = {}  # one open file per split
        rows: dict[str, int] = {}

        def close(value):
            writer, sink = opened.pop(value)
            writer.close()
            sink.close()

        def start_file(value, schema):
            name = f"{self.by}={value}/part-{task}-{len(staged.names):05d}.arrow"
            target = posixpath.join(staged.staging, name)
            filesystem.create_dir(posixpath.dirname(target), recursive=True)
            sink = filesystem.open_output_stream(target)
            staged.names.append(name)
            return pa.ipc.new_file(sink, schema), sink

        for batch in iterator:
            keys = batch.column(self.by)
            body = batch.drop_columns([self.by])
            for key in pc.unique(keys).to_pylist():
                mask = pc.equal(keys, key) if key is not None else pc.is_null(keys)
                part = body.filter(mask)
                value = "__HIVE_DEFAULT_PARTITION__" if key is None else quote(key, safe=" ")
                # Row k of a split goes to file k // rows_per_file, so a batch is cut at multiples.
                first, end = rows.get(value, 0), rows.get(value, 0) + part.num_rows
                cuts = range(first - first % self.rows_per_file, end, self.rows_per_file)
                for cut in cuts:
                    if cut >= first:
                        if value in opened:
                            close(value)
                        opened[value] = start_file(value, part.schema)
                    low = max(cut, first)
                    high = min(cut + self.rows_per_file, end)
                    opened[value][0].write_batch(part.slice(low - first, high - low))
                rows[value] = end
        for value in list(opened):
            close(value)
        return staged

    def commit(self, messages: list) -> None:
        filesystem, root = _filesystem(self.path)
        old = _data_files(filesystem, root) if self.overwrite else []
        moves = [
            (posixpath.join(m.staging, name), posixpath.join(root, name))
            for m in messages
            if m is not None
            for name in m.names
        ]
        for folder in {posixpath.dirname(target) for _, target in moves}:
            filesystem.create_dir(folder, recursive=True)
        # Old files go first: a commit that breaks off leaves too little, never old and new mixed.
        with ThreadPoolExecutor(32) as pool:
            list(pool.map(filesystem.delete_file, old))
            list(pool.map(lambda move: filesystem.move(*move), moves))
        self._drop_staging(filesystem, root)

    def abort(self, messages: list) -> None:
        self._drop_staging(*_filesystem(self.path))

    def _drop_staging(self, filesystem, root: str) -> None:
        from pyarrow import fs

        shared = posixpath.join(root, STAGING)
        own = posixpath.join(shared, self.job)
        if filesystem.get_file_info(own).type == fs.FileType.Directory:
            filesystem.delete_dir(own)
        others = fs.FileSelector(shared, allow_not_found=True)
        if not filesystem.get_file_info(others) and (
            filesystem.get_file_info(shared).type == fs.FileType.Directory
        ):
            filesystem.delete_dir(shared)


@dataclass
class ArrowFile(InputPartition):
    path: str

    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class ArrowIpcReader(DataSourceReader):
    """One partition per file. Only the columns of the schema are read from it:
    give ``spark.read`` a schema to read fewer than all."""

    def __init__(self, options, schema: StructType):
        self.path = options["path"]
        self.schema = schema
        self.only = json.loads(options.get("only", "{}"))
        self.files = json.loads(options["files"]) if "files" in options else None

    def partitions(self) -> list[ArrowFile]:
        filesystem, root = _filesystem(self.path)
        listed = _data_files(filesystem, root) if self.files is None else self.files
        files = [p for p in listed if _wanted(p, self.only)]
        return [ArrowFile(p) for p in files] or [ArrowFile("")]

    def read(self, partition: ArrowFile) -> Iterator:
        import pyarrow as pa

        if not partition.path:
            return
        filesystem, _ = _filesystem(self.path)
        constants = {"_path": partition.path, **_partition_values(partition.path)}
        wanted = set(self.schema.fieldNames())
        with filesystem.open_input_file(partition.path) as stream:
            names = pa.ipc.open_file(stream).schema.names
            kept = [i for i, name in enumerate(names) if name in wanted]
            reader = pa.ipc.open_file(stream, options=pa.ipc.IpcReadOptions(included_fields=kept))
            for i in range(reader.num_record_batches):
                batch = reader.get_batch(i)
                columns = [
                    batch.column(f.name)
                    if f.name in batch.schema.names
                    else pa.array([constants.get(f.name)] * batch.num_rows, pa.string())
                    for f in self.schema
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in self.schema])


class ArrowIpcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        """Columns of the first file, then the partition columns of its path."""
        import pyarrow as pa
        from pyspark.sql.pandas.types import from_arrow_schema

        filesystem, root = _filesystem(self.options["path"])
        named = self.options.get("files")
        files = _data_files(filesystem, root) if named is None else json.loads(named)
        few = json.loads(self.options.get("only", "{}"))
        files = [f for f in files if _wanted(f, few)] or files
        if not files:
            raise FileNotFoundError(f"no Arrow files under {self.options['path']}")
        with filesystem.open_input_file(files[0]) as stream:
            schema = from_arrow_schema(pa.ipc.open_file(stream).schema)
        inside = files[0][len(root.rstrip("/")) + 1 :]
        for part in inside.split("/")[:-1]:
            if "=" in part:
                schema = schema.add(part.partition("=")[0], StringType())
        return schema

    def reader(self, schema: StructType) -> ArrowIpcReader:
        return ArrowIpcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> ArrowIpcWriter:
        return ArrowIpcWriter(self.options, overwrite)


def register_arrow_ipc(spark: SparkSession) -> None:
    """Makes the format known to a session.

    Classes go to the workers by value: they need not have this package installed.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ArrowIpcSource)
