"""Small driver-side file-system calls through Spark's Hadoop configuration.

Only metadata and single small documents go through here (commit markers,
manifests, sidecars); data is always written by Spark tasks.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def write_text_file(spark: SparkSession, path: str, text: str) -> str:
    """Create (or replace) one small text file."""
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return path


def read_text_file(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")   # one call
        return text.replace("\r\n", "\n").removesuffix("\n")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` (empty when it does not exist)."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def partition_folder(spark: SparkSession, values: dict) -> str:
    """``name=value/...`` as Spark's partitioned writer spells it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{escape(k)}={escape(str(v))}" for k, v in values.items())


def rename(spark: SparkSession, src: str, dst: str) -> None:
    p_src, fsys = _path(spark, src)
    p_dst, _ = _path(spark, dst)
    if fsys.exists(p_dst):
        fsys.delete(p_dst, False)
    if not fsys.rename(p_src, p_dst):
        raise IOError(f"rename {src} -> {dst} failed")


def delete(spark: SparkSession, path: str, recursive: bool = True) -> None:
    p, fsys = _path(spark, path)
    if fsys.exists(p):
        fsys.delete(p, recursive)


def write_single_file(df, path: str) -> str:
    """Write a one-column DataFrame of lines as exactly one file at ``path``.

    One task writes the lines (a single file is one writer by nature) into a
    side folder, then the part file is renamed into place: no data passes
    through the driver."""
    spark = df.sparkSession
    tmp = path.rstrip("/") + "._writing"
    df.coalesce(1).write.mode("overwrite").text(tmp)
    part = [n for n in list_names(spark, tmp) if n.startswith("part-")]
    if len(part) != 1:
        raise IOError(f"expected one part file under {tmp}, found {part}")
    rename(spark, f"{tmp}/{part[0]}", path)
    delete(spark, tmp)
    return path


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file only if it does not exist; False when it does.

    Atomic either way: on a local filesystem through the OS's exclusive
    create (``O_CREAT | O_EXCL``), elsewhere through the filesystem's
    create-if-absent (atomic on HDFS, where the name node decides)."""
    import os
    p, fsys = _path(spark, path)
    q = fsys.makeQualified(p).toUri()
    if q.getScheme() in (None, "file"):
        local = q.getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            return True
        except FileExistsError:
            return False
    try:
        fsys.create(p, False).close()
        return True
    except Exception as e:  # noqa: BLE001 -- FileAlreadyExistsException arrives as a Py4J error
        if "FileAlreadyExists" in str(e) or fsys.exists(p):
            return False
        raise
