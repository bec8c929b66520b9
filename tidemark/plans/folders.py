"""Small control files next to the data, through the Hadoop file system of the path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write under a temporary name and rename last: readers see the old or the new file."""
    fs, draft = _open(spark, path + ".draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    jvm, hadoop = spark._jvm, spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, jvm.org.apache.hadoop.fs.Path(path), options)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def matching_folders(spark: SparkSession, path: str, glob: str) -> list[str]:
    """Names of the folders directly below a path that match, without partition folders and hidden ones."""
    fs, target = _open(spark, f"{path}/{glob}")
    found = [(status.isDirectory(), status.getPath().getName()) for status in fs.globStatus(target) or []]
    return sorted(name for is_folder, name in found if is_folder and "=" not in name and name[0] not in "._")


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)
