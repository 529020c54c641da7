"""Small file-system steps, on whatever file system the path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def size(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Publish by rename; refuses to overwrite."""
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    if fs.exists(dst):
        raise FileExistsError(target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {target}")


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move ``source`` over ``target``; what was there is set aside first, then removed."""
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    aside = None
    if fs.exists(dst):
        _, aside = _fs(spark, f"{source}.old")
        # Left over from a run that died after its replacement was in place.
        if fs.exists(aside) and not fs.delete(aside, True):
            raise OSError(f"could not remove {source}.old")
        if not fs.rename(dst, aside):
            raise OSError(f"could not set {target} aside")
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {source} to {target}")
    if aside is not None:
        fs.delete(aside, True)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
