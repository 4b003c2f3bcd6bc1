"""Python workers that cannot import the package: tasks and broadcasts must carry all they need."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"
SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from kmerscope.session import get_session
spark = get_session("local[4]", shuffle_partitions=4)

def importable(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pylist([{{"found": importlib.util.find_spec("kmerscope") is not None}}])

assert not any(r.found for r in spark.range(4).mapInArrow(importable, "found boolean").collect())
import corpus_pipeline
from kmerscope.llm.queries import QUERIES
n = spark.read.parquet("{SF}/documents.parquet").count()
for name in ("op7_quality_zstd", "op9_anchor_dedup", "op13_fill_middle"):
    assert QUERIES[name](spark, "{SF}").toPandas().shape[0] == n, name
assert QUERIES["op12_best_fit_packing"](spark, "{SF}").toPandas().doc_id.nunique() == n
assert 0 < corpus_pipeline.quality(spark, spark.read.parquet("{SF}/documents.parquet"), "{SF}").toPandas().shape[0] < n
"""


def test_operators_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
