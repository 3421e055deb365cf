"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app_name: str = "tripspark",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the pipeline assumes.

    * ``spark.sql.session.timeZone=UTC``: pickup times carry a " UTC" suffix and
      calendar features are defined in UTC (the feature code is zone-independent
      anyway, see ``functions.timefeat``).
    * ANSI stays on (the 4.x default); untrusted strings only ever go through
      ``try_*`` functions.
    * AQE on, so shuffle partition counts coalesce at run time and skewed
      partitions are split.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). When neither is
    set, a local session gets a private temp folder, registered as checkpoint dir, so
    ``DataFrame.checkpoint()`` works too; on a cluster, where executors could not see
    such a folder, that is an error.
    """
    base = None
    try:
        base = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf lookup is best effort
        base = None
    sc = _context(spark)
    if not base and sc is not None:
        base = sc.getCheckpointDir()
    if not base:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tripspark-")
        if sc is not None:
            sc.setCheckpointDir(base)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    return max(sc.defaultParallelism if sc is not None else (os.cpu_count() or 1), 1)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch folder."""
    base = shared_dir(spark)
    path = f"{base}/tripspark/{name}-{uuid.uuid4().hex[:12]}"
    fs, p = _fs(spark, path)
    if fs is not None:
        fs.mkdirs(p)
    return path


def copy_head(spark: SparkSession, source: str, target: str, n_bytes: int) -> None:
    """Copy the first ``n_bytes`` of a file, through Hadoop's FileSystem."""
    jvm = spark.sparkContext._jvm
    (fs, p), (to_fs, to) = _fs(spark, source), _fs(spark, target)
    head = jvm.org.apache.commons.io.input.BoundedInputStream(fs.open(p), n_bytes)
    jvm.org.apache.hadoop.io.IOUtils.copyBytes(head, to_fs.create(to, True), 1 << 16, True)


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file, made with its folders; nothing if it is there."""
    fs, p = _fs(spark, path)
    if fs is not None:
        fs.create(p, True).close()
    else:
        os.makedirs(os.path.dirname(_local(path)), exist_ok=True)
        open(_local(path), "a").close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder once its result is stored elsewhere."""
    fs, p = _fs(spark, path)
    if fs is not None:
        fs.delete(p, True)


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem for ``path``; None without a JVM gateway (then local paths only)."""
    sc = _context(spark)
    if sc is None or getattr(sc, "_jvm", None) is None:
        return None, path
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any cluster store)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p)) if fs is not None else os.path.exists(_local(path))


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """``(name, is_dir)`` of the direct children of ``path`` (empty if missing)."""
    fs, p = _fs(spark, path)
    if fs is None:
        d = _local(path)
        return [(n, os.path.isdir(os.path.join(d, n))) for n in os.listdir(d)] if os.path.isdir(d) else []
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), bool(s.isDirectory())) for s in fs.listStatus(p)]


def file_signature(spark: SparkSession, path: str) -> str:
    """Cheap identity of an input (length + modification time)."""
    fs, p = _fs(spark, path)
    if fs is None:
        st = os.stat(_local(path))
        return f"{st.st_size}-{int(st.st_mtime * 1000)}"
    st = fs.getFileStatus(p)
    return f"{st.getLen()}-{st.getModificationTime()}"


_MATERIALIZE_LOCK = threading.RLock()


def materialize(spark: SparkSession, path: str, write) -> str:
    """Run ``write(path)`` unless ``path`` already holds a complete output (``_SUCCESS``).

    Serialized within the driver, so queries running from several threads of one
    session never write the same table twice or read a half-written one.
    """
    with _MATERIALIZE_LOCK:
        if not path_exists(spark, f"{path}/_SUCCESS"):
            write(path)
    return path
