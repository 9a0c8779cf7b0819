"""Operators with learned models on workers that have no copy of the library."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", sys.argv[1]).getOrCreate()
def absent(batches):
    import importlib.util
    assert importlib.util.find_spec("orelode") is None
    yield from batches
docs = spark.createDataFrame(
    [(i, ("the house and the river " if i % 2 else "das Haus und der Fluss ") * 5 + "call 555 0100", "en" if i % 2 else "de")
     for i in range(60)], "doc_id long, text string, lang string")
assert docs.mapInArrow(absent, docs.schema).count() == 60
from orelode.llm.langid import identify_language
from orelode.llm.crf_pii import find_personal_data
found = identify_language(docs, F.lit(True)).collect()
assert sum(r.lang == r.lang_pred for r in found) >= 58
assert find_personal_data(docs).count() == 60
print("fine")
"""


def test_models_reach_workers_without_the_library(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)], cwd=tmp_path, env=environment, capture_output=True, text=True
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-3000:]
