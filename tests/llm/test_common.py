import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from gleanery.llm import common


class Conf(dict):
    get = dict.get


def session(master, conf=(), checkpoint=None):
    return SimpleNamespace(conf=Conf(conf), sparkContext=SimpleNamespace(master=master, getConf=lambda: Conf(), getCheckpointDir=lambda: checkpoint))


def test_shared_folder():
    assert common.shared_dir(session("yarn", {"spark.checkpoint.dir": "s3://x/"})) == "s3://x/gleanery"
    assert common.shared_dir(session("yarn", checkpoint="hdfs://y")) == "hdfs://y/gleanery"
    assert common.shared_dir(session("local[4]")).startswith("file://")
    for master in ("yarn", "spark://h:1", "local-cluster[2,1,1024]", "k8s://h"):
        with pytest.raises(RuntimeError):
            common.shared_dir(session(master))


def test_swept(spark, tmp_path):
    with common.swept(spark):
        kept = common.Scratch(spark).keep(spark.range(3), "x")
        path = common._SWEPT[-1][0].removeprefix("file://")
        assert kept.count() == 3 and os.path.isdir(path)
    assert not os.path.exists(path)


def test_bounds_of_a_session_stay(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for own, then in (("10", "10"), ("0", "1000"), ("50000", "1000")):
        spark.conf.set(key, own)
        common.prepare(spark)
        assert spark.conf.get(key) == then
    spark.conf.unset(key)


def test_workers_find_the_package(tmp_path):
    """A session that is started in another folder, without the package on the workers' path."""
    code = """
import sys; sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from gleanery.llm import simhash
print("FOUND", simhash.fingerprints(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).count())
"""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "FOUND 1" in out.stdout, out.stderr[-2000:]
