"""Session defaults and the shared scratch area."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

# Folders of sessions that name none, by their warehouse: removed when the interpreter exits.
_OWN: dict[str, str] = {}


def build_session(app: str = "staylake", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the jobs are planned for.

    ``forceOptimizeSkewedJoin`` lets AQE split a hot join key even where that costs one more
    exchange for the aggregate that follows the join.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for written tables and stream checkpoints.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``, which every executor can reach; where
    that is unset, as in tests, in a folder of its own within the warehouse, which they share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_folder(spark.conf.get("spark.sql.warehouse.dir"))
    return os.path.join(root, "staylake", f"{label}-{uuid.uuid4().hex}")


def _own_folder(warehouse: str) -> str:
    if warehouse not in _OWN:
        _OWN[warehouse] = os.path.join(warehouse, f"staylake-scratch-{uuid.uuid4().hex}")
        url = urlparse(_OWN[warehouse])
        if url.scheme in ("", "file"):
            atexit.register(shutil.rmtree, unquote(url.path), ignore_errors=True)
    return _OWN[warehouse]
