"""Driver-side file-system metadata through Hadoop's FileSystem API (listing, existence).

Only names are handled here, never data. A session without JVM access (a remote session) is refused:
the client's own disk is not the cluster's.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()), p
    except AttributeError as e:  # no py4j gateway
        raise OSError(f"cannot reach {path}: the session gives no access to its file systems") from e


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def list_dir_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty if it does not exist)."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def list_file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (empty if it does not exist)."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())


def is_complete(spark: SparkSession, path: str) -> bool:
    """A folder written by a finished Spark job carries ``_SUCCESS``."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, p = _hadoop(spark, path)
    fs.create(p, True).close()


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another name within its file system; the target's parent is made, the target must not exist."""
    fs, p = _hadoop(spark, source)
    _, t = _hadoop(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(p, t):
        raise OSError(f"cannot move {source} to {target}")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder and its content (superseded versions, scratch, replaced loads)."""
    fs, p = _hadoop(spark, path)
    return bool(fs.delete(p, True))
