"""The feed as a stream: each announced archive once, also after failures and restarts."""

import os
import zipfile

import pytest

from newsflow.streaming.feed import feed_stream


class Site:
    """Manifests and archives in a folder."""

    def __init__(self, root):
        self.manifests, self.archives, self.ckpt, self.n = (*(os.path.join(root, d) for d in ("m", "a/x", "ckpt")), 0)
        for d in (self.manifests, self.archives):
            os.makedirs(d)
        self.published = {}

    def archive(self, day, rows=3):
        name = f"{day}.gkg.csv"
        with zipfile.ZipFile(os.path.join(self.archives, name + ".zip"), "w") as zf:
            zf.writestr(name, "".join(f"{day}\t{i}\n" for i in range(rows)))

    def manifest(self, *lines):
        path = os.path.join(self.manifests, f"m{self.n:03d}.txt")
        with open(path, "w") as fh:
            fh.write("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1

    def announce(self, day, host="http://h"):
        self.manifest(f"1 a {host}/{day}.export.CSV.zip", f"2 b {host}/{day}.gkg.csv.zip", "two parts")

    def run(self, spark, fail=False):
        def write(df, batch):
            rows = sorted((os.path.basename(r.archive), r.line_no, r.value, r.first_width) for r in df.collect())
            self.published[batch] = rows
            if fail:
                raise RuntimeError("lost after the write")
        q = (feed_stream(spark, self.manifests, os.path.dirname(self.archives), target_bytes=200).writeStream.foreachBatch(write)
             .option("checkpointLocation", self.ckpt).trigger(availableNow=True).start())
        q.awaitTermination()

    def archives_of(self):
        return [sorted({r[0].split(".")[0] for r in rows}) for _, rows in sorted(self.published.items())]


@pytest.fixture()
def site(scratch):
    return Site(scratch)


def test_each_archive_once(spark, site):
    for day in ("d1", "d2", "d3"):
        site.archive(day)
    site.announce("d1")
    site.announce("d1")  # no new archive since
    site.announce("d2")
    site.run(spark)
    assert site.archives_of() == [["d1", "d2"]]
    assert site.published[0][:3] == [("d1.gkg.csv.zip", i, f"d1\t{i}", 2) for i in range(3)]
    site.run(spark)  # nothing new
    site.announce("d2", host="https://other")  # the same file from another host
    site.announce("d3")
    site.manifest("nothing to announce")
    site.run(spark)
    assert site.archives_of() == [["d1", "d2"], ["d3"]]


def test_failed_batch_is_run_again_alike(spark, site):
    site.archive("d1")
    site.announce("d1")
    site.run(spark)
    site.archive("d2")
    site.announce("d2")
    site.announce("d1")
    with pytest.raises(Exception, match="lost after the write"):
        site.run(spark, fail=True)
    site.archive("d3")
    site.announce("d3")  # arrives before the restart
    site.run(spark)
    assert site.archives_of()[:2] == [["d1"], ["d2"]]  # the failed batch, as it was
    site.run(spark)
    assert site.archives_of() == [["d1"], ["d2"], ["d3"]]


def test_missing_archive_fails_and_is_read_later(spark, site):
    site.announce("d1")
    with pytest.raises(Exception, match="not there yet"):
        site.run(spark)
    site.archive("d1")
    site.run(spark)
    assert site.archives_of() == [["d1"]]


def test_last_line_of_the_kind_counts(spark, site):
    site.archive("d1")
    site.archive("d2")
    site.manifest("1 a http://h/d1.gkg.csv.zip", "1 a http://h/d2.gkg.csv.zip", "1 a http://h/d9.mentions.gkg.zip")
    site.run(spark)
    assert site.archives_of() == [["d2"]]
