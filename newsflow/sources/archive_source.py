"""Zip archives as a Spark data source that plans its partitions from the archives' sizes (SRC-6).

``spark.read.format("zip_lines")`` after ``register``. An archive's member cannot be split, so the plan deals whole
archives out: longest first, each into the partition with the least bytes that still has room
for it, or into a new one. An archive of ``target_bytes`` or more is alone in its task, and no
partition of several archives holds more than ``target_bytes``; many small archives share a task, but
never so many that fewer than ``parallelism`` tasks would be busy.

Options: ``path`` (a folder, read recursively, or one archive), ``suffix`` (of archive files), ``member_suffix``,
``chunk_rows``, ``target_bytes``, ``parallelism``, ``only`` (a JSON list of file names to read; all if missing).
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

NAME = "zip_lines"
TARGET_BYTES = 64 << 20


def pack_longest_first(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Names dealt into bins of at most ``target`` bytes, longest first; larger ones are alone."""
    import heapq
    bins, open_ = [], []  # open_: (bytes, bin number), least first
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if open_ and open_[0][0] + size <= target:
            held, i = heapq.heappop(open_)
        else:
            held, i = 0, len(bins)
            bins.append([])
        bins[i].append(name)
        if held + size < target:
            heapq.heappush(open_, (held + size, i))
    return bins


def register(spark: SparkSession) -> None:
    """Make ``zip_lines`` known to the session (its class is pickled by value: workers need no copy of this package)."""
    from newsflow.sources.archives import LINE_SCHEMA, _worker_helpers
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
    open_fs, archive_lines = _worker_helpers()
    pack, target_bytes, lines_schema = _by_value(pack_longest_first), TARGET_BYTES, LINE_SCHEMA

    class Archives(InputPartition):
        def __init__(self, paths):
            super().__init__(paths)

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.options = options

        def sizes(self):
            from pyarrow import fs
            path = self.options["path"]
            filesystem, root = open_fs(path)
            root = root.rstrip("/")
            info = filesystem.get_file_info(root)
            found = [info] if info.type == fs.FileType.File else filesystem.get_file_info(
                fs.FileSelector(root, recursive=True))
            only = json_of(self.options.get("only"))
            base = path.rstrip("/")
            return {base + f.path[len(root):]: f.size for f in found
                    if f.type == fs.FileType.File and f.path.endswith(self.options.get("suffix", ".zip"))
                    and (only is None or f.base_name in only)}

        def partitions(self):
            sizes, most = self.sizes(), int(self.options.get("target_bytes", target_bytes))
            share = -(-sum(sizes.values()) // int(self.options.get("parallelism", 1)))
            bins = pack(sizes, min(most, max(share, 1)))
            return [Archives(b) for b in bins] or [Archives([])]

        def read(self, partition):
            import pyarrow as pa
            schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("line_no", pa.int64()),
                                ("value", pa.string()), ("first_width", pa.int32())])
            for path in partition.value:
                for frame in archive_lines(path, self.options.get("member_suffix", ".csv"),
                                           int(self.options.get("chunk_rows", 50_000))):
                    yield pa.RecordBatch.from_pandas(frame, schema, preserve_index=False)

    def json_of(text):
        import json
        return None if text is None else set(json.loads(text))

    class ZipLines(DataSource):
        @classmethod
        def name(cls):
            return "zip_lines"

        def schema(self):
            return lines_schema

        def reader(self, schema):
            return Reader(dict(self.options))

    spark.dataSource.register(ZipLines)


def _by_value(function):
    """A copy of a module function that is pickled by value."""
    import types
    copy = types.FunctionType(function.__code__, {"__builtins__": __builtins__}, function.__name__, function.__defaults__)
    copy.__module__ = "__main__"
    return copy


def read_zip_lines(spark: SparkSession, path: str, only: list[str] | None = None, **options):
    """The lines of the archives under ``path``; ``only``: file names to read."""
    register(spark)
    options = {"parallelism": 2 * spark.sparkContext.defaultParallelism, **options}
    reader = spark.read.format(NAME).option("path", path).options(**{k: str(v) for k, v in options.items()})
    if only is not None:
        reader = reader.option("only", json.dumps(sorted(only)))
    return reader.load()
