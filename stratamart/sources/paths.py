"""Small files next to tables, through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _locate(spark, path)
    return files.exists(target)


def read_small_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small file, or None if there is none."""
    files, target = _locate(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the file, then rename over it, so readers see the old or the new text."""
    jvm = spark.sparkContext._jvm
    files, draft = _locate(spark, f"{path}.draft")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        draft.toUri() if draft.toUri().getScheme() else files.getUri(),
        spark.sparkContext._jsc.hadoopConfiguration(),
    )
    context.rename(draft, jvm.org.apache.hadoop.fs.Path(path), options)
