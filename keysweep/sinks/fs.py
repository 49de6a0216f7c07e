"""File-system calls through Hadoop's ``FileSystem`` (the same one Spark writes with).

Only paths are handled here; no data passes through the driver.
"""

from __future__ import annotations

from collections import deque
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    """Recursive delete without trash (erased data must not linger in a trash folder)."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return False
    return bool(fs.delete(p, True))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Move a directory; creates the parent of ``dst``. Atomic on HDFS."""
    s, fs = _path(spark, src)
    d, _ = _path(spark, dst)
    if not fs.exists(s):
        return False
    fs.mkdirs(d.getParent())
    return bool(fs.rename(s, d))


def mkdirs(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.mkdirs(p)


def replace(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a file over another one. On HDFS one atomic step: a reader finds the old file or the new one."""
    jvm = spark._jvm
    s, fs = _path(spark, src)
    d, _ = _path(spark, dst)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(s, d, how)


def in_parallel(call, items, workers: int = 16) -> None:
    """``call(item)`` for every item, on a few driver threads (each call waits for the name node, not for this process);
    items are drawn as they are needed. The first error is raised when the calls under way have ended."""
    with ThreadPoolExecutor(workers) as pool:
        waiting: deque = deque()
        for item in items:
            waiting.append(pool.submit(call, item))
            if len(waiting) >= 4 * workers:
                waiting.popleft().result()
        for done in waiting:
            done.result()


def from_uri(spark: SparkSession, uri: str) -> str:
    """The path of a URL-encoded file name such as ``_metadata.file_path``."""
    jvm = spark._jvm
    return str(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; an existing one is an error."""
    p, fs = _path(spark, path)
    fs.mkdirs(p.getParent())
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def file_system(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """Scheme and authority of the file system that holds ``path``."""
    uri = _path(spark, path)[1].getUri()
    return uri.getScheme(), uri.getAuthority()


def qualify(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    return str(fs.makeQualified(p))


def has_data_files(spark: SparkSession, path: str) -> bool:
    """True when a directory tree holds at least one visible data file."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def list_plain_files(spark: SparkSession, path: str) -> list[str]:
    """Files (not directories) directly inside ``path``, hidden ones excluded."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")):
            out.append(str(st.getPath()))
    return out
