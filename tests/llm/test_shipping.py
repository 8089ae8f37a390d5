"""Tasks need no installed package: the driver's code travels with them."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import pyspark.sql.functions as F
from pyspark.sql.types import BooleanType
@F.udf(BooleanType())
def installed():
    import importlib.util
    return importlib.util.find_spec("codexflow") is not None
assert not spark.range(1).select(installed()).first()[0]
from codexflow.llm import langid, toxicity
docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
n = docs.count()
assert langid.predict_documents(docs, langid.train(docs)).filter("score >= 0").count() == n
model = toxicity.train(docs, labels)
assert toxicity.score_documents(docs, model).filter("score >= 0").count() == n
assert toxicity.drop_toxic(docs, model).count() <= n
"""


def test_workers_without_the_package(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=str(Path(__file__).parents[2])))
    bare = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}  # a path to the package would hide what is tested
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=bare, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
