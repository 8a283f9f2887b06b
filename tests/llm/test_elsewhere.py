"""Executors need no copy of the repository: queries run from another folder, without it on the workers' path."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
RUN = """
import os, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local-cluster[1,2,1500]").config("spark.checkpoint.dir", os.getcwd() + "/shared")
  .config("spark.executor.memory", "1g").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
sys.path.insert(0, {root!r})  # the driver's path alone, after the session has begun
import __spark_entry__ as entry
found = entry.queries()
for name in {names!r}:
    print("ROWS", name, found[name](spark, {sf!r}).count(), flush=True)
os._exit(0)
"""
NAMES = [
    "op1_simhash_near_duplicates", "op2_license_scan", "op3_repeated_passages", "op4_hash_prefix_forest",
    "op5_pfair_mixture", "op6_document_fingerprints", "op7_secret_scan", "op8_bpe_round_trip",
    "op9_jump_hash_shards", "op10_language_id", "op11_merkle_manifest", "op12_passage_attention",
    "op13_reversed_search", "pipeline",
]


@pytest.mark.parametrize("names", [NAMES])
def test_every_operator_runs_from_another_folder(tmp_path, sf_dir, names):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    home = tmp_path / "spark"
    home.mkdir()
    import pyspark

    for part in Path(pyspark.__file__).parent.iterdir():
        if part.name != "work":
            (home / part.name).symlink_to(part)
    env |= {"SPARK_HOME": str(home), "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable, "SPARK_SCALA_VERSION": "2.13"}
    code = RUN.format(root=str(ROOT), names=names, sf=sf_dir)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    rows = {line.split()[1]: int(line.split()[2]) for line in done.stdout.splitlines() if line.startswith("ROWS")}
    assert set(rows) == set(names), done.stderr[-3000:]
    assert all(rows.values())
