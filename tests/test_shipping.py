"""Tasks must not need the package on the executors' path."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from liftworks.operators import model as md
df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 2).alias("a"), (1.0 + F.col("id") % 2).alias("y"))
fitted = md.fit_boosted(df, ["a"], "y", rounds=1, max_depth=1)
assert fitted.contributions(df, "k").count() == 200
assert fitted.contributions(df, "k").agg(F.max("a")).first()[0] > 0
assert md.score(fitted, df).filter("pred > 0").count() == 200
print(md.score(fitted, df).agg(F.sum("pred")).first()[0] > 0)
"""


def test_batch_code_travels_with_the_closure(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0 and done.stdout.strip().endswith("True"), done.stderr[-2000:]
