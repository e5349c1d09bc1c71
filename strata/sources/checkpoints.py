"""The session's checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint directory (``spark.checkpoint.dir``), set where it
    was not yet.

    When nothing is configured, a local-mode session (tests, single-machine
    runs) gets a private temporary directory. On a cluster a machine-local
    folder would not be shared by the executors, so that is an error instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is not set; point it at shared storage "
                             "(HDFS or an object store) that every executor can reach")
        current = tempfile.mkdtemp(prefix="strata-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")
