"""Zip archives of one CSV member (SRC-6), re-aimed as a distributed scan.

Reading: the ``zip_lines`` data source lists the archives, plans its partitions from
their sizes and streams the lines of each archive's first ``.csv`` member in bounded chunks
through ``pyarrow.fs``. A zip member is not splittable, so a large archive is one task;
``spread`` repartitions the lines afterwards so the work downstream of it is shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LINE_SCHEMA = "archive string, member string, line_no long, value string, first_width int"
WRITE_SCHEMA = "archive string, lines long"


def _worker_helpers():
    """``(open_fs, archive_lines)`` as nested functions.

    Functions defined inside a call are pickled by value, so the Python workers
    need neither this package on their path nor the driver's working folder.
    """
    import io
    import zipfile

    import pandas as pd

    def open_fs(uri):
        # (filesystem, path) for a plain path, a file: URI or any pyarrow.fs URI (hdfs, s3, gs).
        from pyarrow import fs
        if uri.startswith("file:"):
            local = uri[len("file:"):]
            while local.startswith("//"):
                local = local[1:]
            return fs.LocalFileSystem(), local
        if "://" not in uri:
            return fs.LocalFileSystem(), uri
        return fs.FileSystem.from_uri(uri)

    def archive_lines(uri, member_suffix, chunk):
        filesystem, path = open_fs(uri)
        with filesystem.open_input_file(path) as raw, zipfile.ZipFile(raw) as zf:
            names = [n for n in zf.namelist() if n.endswith(member_suffix)]
            if not names:
                return
            member = names[0]
            with zf.open(member) as fh:
                text = io.TextIOWrapper(fh, encoding="utf-8", errors="replace", newline=None)
                buf, start, width = [], 0, None

                def frame():
                    return pd.DataFrame({"archive": uri, "member": member, "line_no": range(start, start + len(buf)),
                                         "value": buf, "first_width": pd.array([width] * len(buf), "Int32")})

                for line in text:
                    line = line.rstrip("\n")
                    if width is None and line.strip():
                        width = line.count("\t") + 1
                    buf.append(line)
                    if len(buf) >= chunk:
                        yield frame()
                        start += len(buf)
                        buf = []
                if buf:
                    yield frame()

    return open_fs, archive_lines


def read_archives(spark: SparkSession, path: str, member_suffix: str = ".csv",
                  chunk_rows: int = 50_000, spread: int | None = None,
                  only_names: DataFrame | None = None, target_bytes: int | None = None) -> DataFrame:
    """``(archive, member, line_no, value, first_width)`` for every line of the first ``member_suffix`` member.

    ``first_width`` is the number of tab-separated fields of the member's first line that is not
    blank (NULL on the lines before it). ``only_names`` (a column ``archive_name``: file names)
    restricts the scan to those archives before any is opened.
    Tasks are planned from the archives' sizes (``archive_source``): an archive of ``target_bytes`` or more is
    alone in its task, small ones share one. The names of one pass and the listing of files come to the driver.
    """
    from newsflow.sources.archive_source import read_zip_lines
    only = None if only_names is None else [r.archive_name for r in only_names.select("archive_name").distinct().collect()]
    options = {} if target_bytes is None else {"target_bytes": target_bytes}
    out = read_zip_lines(spark, path, only, member_suffix=member_suffix, chunk_rows=chunk_rows, **options)
    return out.repartition(spread) if spread else out


def write_archives(lines: DataFrame, path: str, name_col: str, order_col: str) -> DataFrame:
    """Write lines as zip archives: per Spark partition, one archive per value of ``name_col``.

    Rows are sorted inside each partition (no shuffle of the whole set into one
    task) and streamed into the zip member, so memory stays bounded. Returns
    ``(archive, lines)`` per written archive; nothing is written until it is evaluated.
    """
    root = path.rstrip("/")

    open_fs, _ = _worker_helpers()

    def write(batches):
        import zipfile

        import pandas as pd
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        current, zf, fh, count, written = None, None, None, 0, []
        filesystem = tmp = final = out = target = None

        def close():
            if zf is not None:
                fh.close()
                zf.close()
                out.close()
                # Publish the finished archive under its final name (a retried or
                # speculative attempt writes its own temporary file).
                filesystem.move(tmp, final)
                written.append((target, count))

        for pdf in batches:
            for name, value in zip(pdf[name_col], pdf["value"]):
                if name != current:
                    close()
                    current, count = name, 0
                    member = name.rsplit("/", 1)[-1].removesuffix(".zip")
                    target = f"{root}/{member}-{part:05d}.zip"
                    filesystem, final = open_fs(target)
                    filesystem.create_dir(final.rsplit("/", 1)[0], recursive=True)
                    tmp = f"{final}.attempt-{TaskContext.get().attemptNumber()}.tmp"
                    out = filesystem.open_output_stream(tmp)
                    zf = zipfile.ZipFile(out, "w", compression=zipfile.ZIP_DEFLATED)
                    fh = zf.open(member, "w", force_zip64=True)
                fh.write(value.encode("utf-8") + b"\n")
                count += 1
        close()
        yield pd.DataFrame(written, columns=["archive", "lines"])

    ordered = lines.sortWithinPartitions(name_col, order_col)
    return ordered.select(name_col, order_col, "value").mapInPandas(write, WRITE_SCHEMA)
