"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "geopanel", **settings: str) -> SparkSession:
    """A session with adaptive execution and UTC; resources come from the submit command."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Otherwise every column call records its call site.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="geopanel-")


_own: dict[tuple[str, str], str] = {}


def _own_folder(root: str, files: tuple | None, application: str) -> str:
    """A folder of this session under the shared one, deleted when its process ends."""
    path = f"{root.rstrip('/')}/geopanel-{application}-{uuid.uuid4().hex[:8]}"
    if files is not None:
        jvm, configuration = files
        where = jvm.org.apache.hadoop.fs.Path(path)
        system = where.getFileSystem(configuration)
        system.mkdirs(where)
        system.deleteOnExit(where)
    return path


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the folder all executors share (``spark.checkpoint.dir``).

    What is written there goes when the session's process ends. Only a session without
    executors, one process that does all the work, may do without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    jvm = getattr(spark, "_jvm", None)
    files = None if jvm is None else (jvm, spark._jsc.hadoopConfiguration())
    application = context.applicationId if jvm is not None else "session"
    if (root, application) not in _own:
        _own[root, application] = _own_folder(root, files, application)
    return f"{_own[root, application]}/{name}-{uuid.uuid4().hex}"
