"""Operators whose tasks run Python, where the workers can't import the package."""

import os
import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[2])
CODE = f"""
import sys, tempfile
sys.path.insert(0, {REPO!r})  # the driver's path only
import __spark_entry__ as E
from pyspark.sql import functions as F
from ledgerloom.session import build_session
spark = build_session("local[2]", 4, extra={{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ll-test-ckpt-")}})

@F.udf("string")
def missing(x):
    try:
        import ledgerloom
        return "there"
    except ModuleNotFoundError:
        return "missing"

assert spark.range(1).select(missing("id")).first()[0] == "missing"
for name in sys.argv[1:]:
    print(name, E.queries()[name](spark, "/root/testdata/sf0.001").count(), flush=True)
spark.stop()
"""
QUERIES = ["op1_toxicity", "op4_token_counts", "op5_chat_format", "op6_packing", "op7_token_files", "op8_jaccard_join", "op9_embedding_dedup",
           "op12_prefix_trie", "op13_periodic_runs"]


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE, *QUERIES], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == QUERIES
