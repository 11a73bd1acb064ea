"""The archive source: longest-first plans, even tasks, the same lines."""

import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from newsflow.sources.archive_source import pack_longest_first, read_zip_lines
from newsflow.sources.archives import read_archives


@pytest.mark.parametrize("target", [1, 50, 300])
def test_plan(target):
    rng = random.Random(target)
    for _ in range(50):
        sizes = {f"a{i}": rng.choice([0, 1, 5, 40, 49, 50, 51, 400]) for i in range(rng.randrange(0, 40))}
        bins = pack_longest_first(sizes, target)
        assert sorted(n for b in bins for n in b) == sorted(sizes)
        for b in bins:
            assert len(b) == 1 or sum(sizes[n] for n in b) <= target
            assert sum(sizes[n] >= target for n in b) <= 1
        light = [b for b in bins if sum(sizes[n] for n in b) * 2 < target]
        assert len(light) <= 1  # two partitions that are less than half full would have been one


def archives(folder, n, lines_of):
    for i in range(n):
        sub = os.path.join(folder, f"s{i % 3}")
        os.makedirs(sub, exist_ok=True)
        with zipfile.ZipFile(os.path.join(sub, f"f{i:02d}.gkg.csv.zip"), "w") as zf:
            zf.writestr(f"f{i:02d}.gkg.csv", "".join(f"{i}\t{j}\tx\n" for j in range(lines_of(i))))


def tasks(df):
    """Archives by task."""
    out = {}
    for r in df.select(F.spark_partition_id().alias("p"), "archive").distinct().collect():
        out.setdefault(r.p, []).append(r.archive)
    return list(out.values())


def test_one_large_archive_a_task(spark, scratch):
    archives(scratch, 40, lambda i: 500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        names = spark.createDataFrame([(f"f{i:02d}.gkg.csv.zip",) for i in range(40)], "archive_name string")
        alone = read_archives(spark, scratch, only_names=names, target_bytes=1000)
        assert sorted(map(len, tasks(alone))) == [1] * 40 and alone.count() == 40 * 500
        busy = 2 * spark.sparkContext.defaultParallelism  # small archives share tasks, but leave none idle
        assert min(40, busy) <= len(tasks(read_archives(spark, scratch))) <= 40
        shared = tasks(read_zip_lines(spark, scratch, parallelism=1))
        assert len(shared) == 1 and len(shared[0]) == 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_mixed_sizes_and_lines(spark, scratch):
    archives(scratch, 9, lambda i: 4000 if i % 4 == 0 else 10)
    open(os.path.join(scratch, "other.txt"), "w").close()
    df = read_zip_lines(spark, f"file://{scratch}", chunk_rows=70, target_bytes=20_000)
    large = {f"f{i:02d}.gkg.csv.zip" for i in (0, 4, 8)}
    assert all(sum(os.path.basename(a) in large for a in t) <= 1 for t in tasks(df))
    got = df.withColumn("name", F.element_at(F.split("archive", "/"), -1)).collect()
    want = {(f"f{i:02d}.gkg.csv.zip", f"f{i:02d}.gkg.csv", j, f"{i}\t{j}\tx", 3) for i in range(9) for j in range(4000 if i % 4 == 0 else 10)}
    assert {(r.name, r.member, r.line_no, r.value, r.first_width) for r in got} == want and len(got) == len(want)


def test_names_and_empty_folder(spark, scratch):
    archives(scratch, 3, lambda i: i)
    assert read_zip_lines(spark, scratch, only=["f02.gkg.csv.zip", "none.zip"]).count() == 2
    assert read_zip_lines(spark, scratch, only=[]).count() == 0
    assert read_zip_lines(spark, os.path.join(scratch, "s1", "f01.gkg.csv.zip")).count() == 1
    os.makedirs(os.path.join(scratch, "empty"))
    assert read_zip_lines(spark, os.path.join(scratch, "empty")).count() == 0
