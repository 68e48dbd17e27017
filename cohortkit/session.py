"""Where to put intermediate files: the cluster's shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    On a cluster this is shared storage every executor can reach. Only when
    the session has none (local tests) is a fresh local folder created and
    registered as the checkpoint folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compiled(spark: SparkSession, limit: int = 8000) -> None:
    """Let generated code be compiled: HotSpot interprets methods of more than 8,000 bytes, and the
    finished frame's are larger. With this limit such stages run as split projections, to the same
    rows. A limit that the session was given stays."""
    if int(spark.conf.get(METHOD_LIMIT)) > limit and METHOD_LIMIT not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set(METHOD_LIMIT, str(limit))


_handed_out: dict[str, object] = {}  # path -> a function that deletes it


def _deleter(spark: SparkSession, name: str):
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()

    def delete() -> None:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    return delete


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder. What is there goes with ``drop_scratch``,
    with the ``Scratch`` around the call, or else when Python ends."""
    base = shared_dir(spark).rstrip("/")
    if "://" not in base:
        os.makedirs(base, exist_ok=True)
    path = f"{base}/cohortkit/{name}-{uuid.uuid4().hex}"
    if not _handed_out:
        atexit.register(_drop_rest)
    _handed_out[path] = _deleter(spark, path)
    return path


def scratch_paths() -> list[str]:
    """The paths handed out and not yet dropped, oldest first."""
    return list(_handed_out)


def drop_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete what was written under ``paths`` (default: all from ``scratch_path``).
    Frames that still read from there fail afterwards, so call it when their
    results are written."""
    for name in scratch_paths() if paths is None else paths:
        (_handed_out.pop(name, None) or _deleter(spark, name))()


def _drop_rest() -> None:
    while _handed_out:
        try:
            _handed_out.popitem()[1]()
        except Exception:  # the JVM is gone: nothing more can be removed from here
            _handed_out.clear()


class Scratch:
    """Owns the scratch paths handed out while it is open, and removes them when it closes.

    ``with Scratch(spark): run(...).write.parquet(out)`` leaves nothing behind, also
    when the job fails. ``keep`` takes a path out of its care.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def __enter__(self) -> Scratch:
        self._before = set(_handed_out)
        return self

    def paths(self) -> list[str]:
        return [p for p in _handed_out if p not in self._before]

    def keep(self, path: str) -> None:
        self._before.add(path)

    def __exit__(self, *error) -> None:
        drop_scratch(self._spark, self.paths())
