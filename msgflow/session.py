"""Session settings the library expects, shipping of the package, and the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# UTC for times; adaptive execution sizes, joins and splits shuffles from measured data; RocksDB
# keeps streaming state off the heap.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_shipped: set[str] = set()


def builder(app_name: str = "msgflow") -> SparkSession.Builder:
    """A session builder with the settings above; cluster sizes are left to the caller."""
    out = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        out = out.config(key, value)
    return out


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application.

    Executors get it as an archive. Streams also start Python processes beside the driver, which
    archives do not reach: those find it by path.
    """
    context = spark.sparkContext
    app = context.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    known = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    context.environment["PYTHONPATH"] = os.pathsep.join([*known, os.path.dirname(root)])
    target = os.path.join(tempfile.mkdtemp(prefix="msgflow-"), "msgflow.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("msgflow", os.path.relpath(path, root)))
    context.addPyFile(target)
    _shipped.add(app)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may go without that setting; it then uses a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="msgflow-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
