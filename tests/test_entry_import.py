"""The driver imports the registry without a session, and with PySpark loaded from its zip."""

import glob
import os
import pathlib
import subprocess
import sys

import pyspark

REPO = pathlib.Path(__file__).resolve().parent.parent


def _import(path):
    code = "import __spark_entry__ as e, pyspark; print(pyspark.__file__, len(e.queries()), len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "SPARK_HOME"} | {"PYTHONPATH": os.pathsep.join(path)}
    return subprocess.run([sys.executable, "-c", code], cwd=REPO, env=env, capture_output=True, text=True, timeout=120)


def test_import_without_session():
    done = _import([str(REPO)])
    assert done.returncode == 0, done.stderr


def test_import_with_pyspark_from_zip():
    lib = pathlib.Path(pyspark.__file__).parent / "python" / "lib"
    zips = glob.glob(str(lib / "pyspark.zip")) + glob.glob(str(lib / "py4j-*.zip"))
    done = _import([*zips, str(REPO)])
    assert done.returncode == 0, done.stderr
    assert "pyspark.zip" in done.stdout
