"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_own_folders: dict[str, str] = {}


def build_session(app_name: str = "orelode", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    No operator depends on them for its result: timestamps are zone-free, partition
    columns are read with explicit types and every cast or division is a ``try_`` one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` where the session names one.

    Only a local session may fall back to a temporary folder of its own; on a cluster
    the setting is required, because a machine-local folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="orelode-")
    return _own_folders[context.applicationId]


def application_folder(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_folder(spark)}/orelode/{spark.sparkContext.applicationId}"
