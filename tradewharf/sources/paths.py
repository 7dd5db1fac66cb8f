"""Folder helpers on the cluster's file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column, from the folder names."""
    fs, p = _fs(spark, path)
    prefix = f"{column}="
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    return sorted(n[len(prefix) :] for n in names if n.startswith(prefix))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none where there is no folder."""
    fs, p = _fs(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(p)) if fs.exists(p) else []


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to a place that is free; the folder above is made."""
    fs, p = _fs(spark, source)
    _, to = _fs(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{source} could not be moved to {target}")


def rename_all(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Several moves between folders of one file system; the folders above the targets are made."""
    if not moves:
        return
    fs, _ = _fs(spark, moves[0][0])
    path = spark._jvm.org.apache.hadoop.fs.Path
    for above in {target.rsplit("/", 1)[0] for _, target in moves}:
        fs.mkdirs(path(above))
    for source, target in moves:
        if not fs.rename(path(source), path(target)):
            raise OSError(f"{source} could not be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()
