"""All training-data queries where the workers cannot import the package."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from leadrank.llm import queries
from leadrank.session import local_session

spark = local_session(4, "without-the-package")

def importable(batches):
    import pyarrow as pa
    try:
        import leadrank
        found = True
    except ImportError:
        found = False
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([found] * b.num_rows)], names=["found"])

importable.__module__ = "__main__"
assert [r.found for r in spark.range(1).mapInArrow(importable, "found boolean").collect()] == [False]
for name in [*queries.all_queries(), "pipeline"]:
    entry.queries()[name](spark, {sf!r}).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


def test_workers_without_the_package(sf, tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=str(ROOT), sf=sf))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=_plain_environment(), capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") == 14


def _plain_environment():
    import os

    path = [p for p in os.environ.get("PYTHONPATH", "").split(":") if p and Path(p).resolve() != ROOT]
    return {**os.environ, "PYTHONPATH": ":".join(path)}
