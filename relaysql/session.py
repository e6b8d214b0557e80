"""Sessions and shared folders.

Each job runs in its own ``spark.newSession()``: that isolates the ``source``
view and the job's functions from other jobs, and lets the job use the SQL
semantics it was written for (non-ANSI: ``1/0`` is NULL, bad casts are NULL)
without changing the caller's session. Streaming queries started from that
session keep both inside ``foreachBatch``.

Anything a job writes outside the sink (stream checkpoints, staged files) goes
under ``spark.checkpoint.dir``, the shared folder the cluster names. It is read
from the session; only when it is unset in local mode (local runs and tests) is
a folder of our own created and set - on a cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Session settings every job session gets.
JOB_CONF = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def job_session(spark: SparkSession, conf: dict | None = None) -> SparkSession:
    """A new session sharing ``spark``'s context, with the job settings."""
    session = spark.newSession()
    for k, v in {**JOB_CONF, **(conf or {})}.items():
        session.conf.set(k, v)
    return session


def _conf(spark: SparkSession, key: str) -> str | None:
    value = spark.conf.get(key, None)
    if not value:
        value = spark.sparkContext.getConf().get(key, None)
    return value or None


class CheckpointDirMissing(RuntimeError):
    """No shared checkpoint folder is configured on a cluster."""


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    ``spark.checkpoint.dir`` when set, else the context's checkpoint folder.
    Only in local mode (tests, a laptop) is a local folder created when neither
    is set; on a cluster that is an error, because executors and a restarted
    driver must all see the folder.
    """
    sc = spark.sparkContext
    root = _conf(spark, CHECKPOINT_CONF) or sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise CheckpointDirMissing(
            f"set {CHECKPOINT_CONF} to a folder every node can reach (HDFS, object store)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="relaysql-checkpoint-"))
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the checkpoint folder, by default made unique per call."""
    root = checkpoint_root(spark).rstrip("/")
    tail = [p.strip("/") for p in parts]
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([root, "relaysql", *tail]) if "://" in root else os.path.join(root, "relaysql", *tail)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``relaysql`` importable by Python workers (as ``--py-files`` would).

    Python functions registered by a job are pickled by reference, so executors
    must import this package. It is zipped once per Spark application on the
    driver and added with ``addPyFile``, which serves it to the executors
    whatever kind of folder the checkpoints go to. User modules named in a
    function config must be deployed by the user in the same way.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="relaysql-package-"), "relaysql.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
