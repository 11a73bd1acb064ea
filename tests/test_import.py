"""The entry module must import where ``pyspark`` is the zip that ``spark-submit`` uses, from any folder."""

import os
import subprocess
import sys

import pyspark

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _lib() -> str:
    return os.path.join(os.path.dirname(os.path.abspath(pyspark.__file__)), "python", "lib")


def _run(code: str, cwd, path: str) -> str:
    env = {**os.environ, "PYTHONPATH": path, "SPARK_LOCAL_IP": "127.0.0.1"}
    env.pop("SPARK_HOME", None)
    out = subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_entry_imports_from_pyspark_zip(tmp_path):
    zips = [os.path.join(_lib(), n) for n in sorted(os.listdir(_lib())) if n.endswith(".zip")]
    code = (f"import sys; sys.path.insert(0, {REPO!r}); import pyspark, __spark_entry__ as e; "
            "print('pyspark.zip' in pyspark.__file__, len(e.queries()) >= 49, len(e.oracle_sql()) >= 45)")
    assert _run(code, tmp_path, ":".join(zips)).split() == ["True", "True", "True"]


def test_zip_scan_from_another_folder(tmp_path):
    """The Python workers get their functions by value: the package is not on their path."""
    code = (f"import sys; sys.path.insert(0, {REPO!r}); import __spark_entry__ as e; "
            "from newsflow.session import build_session; s = build_session(master='local[2]'); "
            "print('ROWS', e.queries()['zip_scan'](s, '/root/testdata/sf0.001').count())")
    assert int(_run(code, tmp_path, "").split("ROWS")[1]) > 0
