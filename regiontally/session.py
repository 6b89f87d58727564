"""Session helpers: a local session for tests and benches, and the shared folder.

Library functions never create a session; they take the caller's. Scratch
output (delta logs, staged streams, written tables) goes under the folder the
cluster names in ``spark.checkpoint.dir``, which on a cluster is shared
storage that survives the loss of any executor. Only when that setting is
unset, as in a bare local test, a private temporary folder is created and
installed as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans built here; sized for local[8] tests.
# On a cluster the deployment's own values win (see ``local_session``).
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def local_session(master: str = "local[8]", app_name: str = "regiontally", **conf) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Only on a local master is a private folder created when none is set; on a
    cluster a machine-local folder would lose data, so that is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # setCheckpointDir appends a per-application subfolder; its parent is the root.
            root = current.rstrip("/").rsplit("/", 1)[0]
    if not root and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="regiontally-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the shared checkpoint root, fresh per call unless ``unique`` is False."""
    path = "/".join([checkpoint_root(spark), "regiontally", *parts])
    return f"{path}/{uuid.uuid4().hex}" if unique else path
