"""The driver contract stands without the training-data folders."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import __spark_entry__ as e
from lendlayer.plans.oracle import ORACLE
from lendlayer.plans.queries import QUERIES
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(ORACLE), sorted(e.queries())
from lendlayer.session import local_session
spark = local_session(2, 2)
spark.sparkContext.setCheckpointDir("ckpt")
for name in ("dq_summary", "run_report", "gold_borrowers"):
    assert e.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("fine")
"""


@pytest.mark.parametrize("with_pipeline", [True, False])
@pytest.mark.parametrize("left", ["nothing", "an empty folder"])
def test_without_the_training_data_folders(tmp_path, with_pipeline, left):
    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(f"{ROOT}/lendlayer", tmp_path / "lendlayer", ignore=skip)
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if with_pipeline:
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    if left == "an empty folder":
        (tmp_path / "lendlayer" / "llm" / "__pycache__").mkdir(parents=True)
    code = CODE if left == "nothing" and not with_pipeline else CODE.split("from lendlayer.session")[0] + "print('fine')"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]
