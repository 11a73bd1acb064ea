"""The article feed as a stream (SRC-7, SRC-9, SRC-6): manifests announce archives, the checkpoint is the memory.

``spark.readStream.format("feed_archives")`` after ``register_feed``. An offset is the place of the last manifest taken,
by modification time and name. A batch holds the lines of the archives that its manifests announce (the last line
of the wanted kind per manifest) and that no earlier manifest announced, by file name: what is new follows from the
offsets alone, so a batch that failed and is run again after a restart holds the same archives, and each
archive is in one batch. An announced archive that is not there yet fails the batch, which is then run again.

Partitions are planned from the archives' sizes, longest first (``sources.archive_source``). The driver keeps
the name and place of each archive announced so far, as Spark's own file source does of its files.

Options: ``manifests`` (folder), ``archives`` (folder, searched recursively), ``kind``, ``member_suffix``,
``chunk_rows``, ``target_bytes``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAME = "feed_archives"


def register_feed(spark: SparkSession) -> None:
    """Make ``feed_archives`` known to the session (pickled by value, as ``zip_lines``)."""
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    from newsflow.sources.archive_source import TARGET_BYTES, _by_value, pack_longest_first
    from newsflow.sources.archives import LINE_SCHEMA, _worker_helpers
    from newsflow.sources.manifest import KIND_MARKERS
    open_fs, archive_lines = _worker_helpers()
    pack, target_bytes, lines_schema, markers = _by_value(pack_longest_first), TARGET_BYTES, LINE_SCHEMA, KIND_MARKERS

    class Archives(InputPartition):
        def __init__(self, paths):
            super().__init__(paths)

    class Feed(DataSourceStreamReader):
        def __init__(self, options):
            self.options, self.first, self.taken = options, {}, (0, "")

        def listed(self, path):
            """``{(modification time, path): size}`` of the files below a folder, hidden ones left out."""
            from pyarrow import fs
            filesystem, root = open_fs(path)
            found = filesystem.get_file_info(fs.FileSelector(root.rstrip("/"), recursive=True))
            return filesystem, {(f.mtime_ns or 0, f.path): f.size for f in found
                                if f.type == fs.FileType.File and f.base_name[:1] not in "._"}

        def announced(self, filesystem, path):
            """File name of the archive that a manifest announces last, or None."""
            kind, name = self.options.get("kind", "gkg"), None
            with filesystem.open_input_stream(path) as raw:
                for line in raw.read().decode("utf-8", "replace").splitlines():
                    parts = line.split()
                    of = [k for k, mark in markers if len(parts) == 3 and mark in parts[2]]
                    if of and of[0] == kind:
                        name = parts[2].rsplit("/", 1)[-1]
            return name

        def initialOffset(self):
            return {"time": 0, "manifest": ""}

        def latestOffset(self):
            _, found = self.listed(self.options["manifests"])
            time, name = max(found, default=(0, ""))
            return {"time": time, "manifest": name}

        def partitions(self, start, end):
            low, high = ((o["time"], o["manifest"]) for o in (start, end))
            filesystem, found = self.listed(self.options["manifests"])
            if self.taken > low:  # an older batch is run again
                self.first, self.taken = {}, (0, "")
            for place in sorted(p for p in found if self.taken < p <= high):
                name = self.announced(filesystem, place[1])
                if name is not None:
                    self.first.setdefault(name, place)
            self.taken = high
            new = {name for name, place in self.first.items() if low < place <= high}
            base = self.options["archives"].rstrip("/")
            _, root = open_fs(base)
            sizes, missing = {}, set(new)
            for (_, path), size in sorted(self.listed(base)[1].items()):
                name = path.rsplit("/", 1)[-1]
                if name in missing:
                    missing.discard(name)
                    sizes[base + path[len(root.rstrip("/")):]] = size
            if missing:
                raise FileNotFoundError(f"announced archives not there yet: {sorted(missing)[:5]}")
            bins = pack(sizes, int(self.options.get("target_bytes", target_bytes)))
            return [Archives(b) for b in bins] or [Archives([])]

        def read(self, partition):
            import pyarrow as pa
            schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("line_no", pa.int64()),
                                ("value", pa.string()), ("first_width", pa.int32())])
            for path in partition.value:
                for frame in archive_lines(path, self.options.get("member_suffix", ".csv"),
                                           int(self.options.get("chunk_rows", 50_000))):
                    yield pa.RecordBatch.from_pandas(frame, schema, preserve_index=False)

        def commit(self, end):
            pass  # the checkpoint holds the offsets

    class FeedArchives(DataSource):
        @classmethod
        def name(cls):
            return "feed_archives"

        def schema(self):
            return lines_schema

        def streamReader(self, schema):
            return Feed(dict(self.options))

    spark.dataSource.register(FeedArchives)


def feed_stream(spark: SparkSession, manifests: str, archives: str, **options) -> DataFrame:
    """``(archive, member, line_no, value, first_width)`` of every announced archive, once."""
    register_feed(spark)
    return spark.readStream.format(NAME).options(
        manifests=manifests, archives=archives, **{k: str(v) for k, v in options.items()}).load()
