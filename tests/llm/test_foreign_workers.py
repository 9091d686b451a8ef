"""All queries where the executors do not have the package: run from a foreign folder."""

import os
import subprocess
import sys

import pytest
from shedlake.llm.queries import QUERIES

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import importlib.util, os, sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry_points
sys.path.remove({repo!r})
from shedlake.session import local_session
spark = local_session("foreign", cores=8)

def importable(rows):
    import importlib.util
    for batch in rows:
        yield batch.assign(found=importlib.util.find_spec("shedlake") is not None)

queries = entry_points.queries()
assert not spark.range(1).mapInPandas(importable, "id long, found boolean").first().found
for name in {names!r}:
    queries[name](spark, {sf_dir!r}).write.format("noop").mode("overwrite").save()
    print("done", name)
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata"), reason="needs the test tables")
def test_workers_without_the_package(tmp_path, sf_dir):
    names = [*QUERIES, "pipeline"]
    code = SCRIPT.format(repo=REPO, names=names, sf_dir=sf_dir)
    # sys.path is changed before Spark starts, and its workers inherit PYTHONPATH only.
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-3000:]
    assert [line.split()[1] for line in run.stdout.splitlines() if line.startswith("done")] == names
