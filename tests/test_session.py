"""Shared folder, intermediate tables and the package on the workers."""

import zipfile

import pytest
from pyspark.sql import functions as F

from pradera import session


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, master, conf=None, folder=None):
        self.sparkContext, self.conf = _Context(master, folder), conf or {}


def test_a_cluster_has_to_name_its_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(_Session(master))
    named = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///x"})
    assert session.ensure_checkpoint_dir(named) == "hdfs:///x"
    assert session.ensure_checkpoint_dir(_Session("yarn", folder="hdfs:///y")) == "hdfs:///y"
    for master in ("local", "local[*]", "local[4]"):
        assert session.ensure_checkpoint_dir(_Session(master))


def test_intermediate_tables_lie_in_the_application_s_folder(spark):
    d = session.write_once(spark.range(10).withColumn("x", F.lit("a")), "t")
    assert d.count() == 10 and d.dtypes == [("id", "bigint"), ("x", "string")]
    own = f"pradera-{spark.sparkContext.applicationId}"
    assert all(f"/{own}/t-" in f for f in d.inputFiles())
    assert session.scratch_path(spark, "t") != session.scratch_path(spark, "t")


def test_the_package_is_shipped_once(spark):
    session.ship_package(spark)
    session.ship_package(spark)
    assert spark.sparkContext._python_includes.count("pradera.zip") == 1
    from pyspark import SparkFiles
    with zipfile.ZipFile(SparkFiles.get("pradera.zip")) as z:
        assert "pradera/session.py" in z.namelist() and all(n.endswith(".py") for n in z.namelist())
