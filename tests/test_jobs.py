"""JOB-2 on a file and the command-line entry (JOB-6)."""

import os

from newsflow.operators.model import ModelStore
from newsflow.plans.clean import preprocess_batch
from tests.test_sources import gkg_line


def write_tsv(folder):
    os.makedirs(folder, exist_ok=True)
    lines = [gkg_line(27, "r1", url="http://a.com/1", tone="-3,1", themes="ECON_TAX;Economy"),
             gkg_line(27, "r2", url="http://a.com/1", date="20260517110000", tone="3,1", themes="Taxi;economy"),
             gkg_line(27, "r3", url="http://b.org/2", tone="0,1", themes="Inflation;;taxi"),
             gkg_line(27, "r4", url="", date="bad")]
    with open(os.path.join(folder, "x.gkg.csv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_preprocess_batch_with_store(spark, scratch):
    src = os.path.join(scratch, "in")
    write_tsv(src)
    store = ModelStore(spark, os.path.join(scratch, "models"))
    out = preprocess_batch(spark, src, store=store)
    rows = {r.url: r for r in out.collect()}
    assert set(rows) == {"http://a.com/1", "http://b.org/2"}
    assert rows["http://a.com/1"].record_id == "r2" and rows["http://a.com/1"].sentiment_label == "positive"
    assert rows["http://a.com/1"].source == "a.com" and rows["http://b.org/2"].features.size == 10_000
    assert store.current_version() is not None
    again = preprocess_batch(spark, src, store=ModelStore(spark, store.root))  # loads, does not retrain
    assert again.count() == 2


def test_cli_preprocess(spark, scratch, capsys):
    from newsflow.__main__ import main
    src = os.path.join(scratch, "in")
    write_tsv(src)
    main(["preprocess", src, "--show", "5", "--models", os.path.join(scratch, "m")])
    assert "http://b.org/2" in capsys.readouterr().out
