"""Small file-system calls through Hadoop, so that any path Spark can write works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none when it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False when there is one already, also if another did it just now."""
    fs = _fs(spark, path)
    fs.mkdirs(_path(spark, path).getParent())
    try:
        return fs.createNewFile(_path(spark, path))
    except Exception:
        if exists(spark, path):
            return False
        raise
