"""A log of numbered commits in a shared folder: what makes several written folders visible at once.

Commit n is one small JSON file, written under another name and then renamed to its number.  A rename needs no data to move
and fails when the number is taken, so of two jobs that read the same last commit one gets the next number and the other
stops (``ConflictError``): readers see either all of a commit or nothing.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession


class ConflictError(RuntimeError):
    """Another job has committed meanwhile; read the log again and start over."""


def file_system(spark: SparkSession, path: str):
    """(file system, Path) of ``path``, wherever it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder (none when it is missing)."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _read(spark: SparkSession, path: str) -> dict:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def entries(spark: SparkSession, log: str) -> list[tuple[int, dict]]:
    """The commits of ``log``, oldest first."""
    names = [(int(m.group(1)), n) for n in folders(spark, log) if (m := re.fullmatch(r"(\d+)\.json", n))]
    return [(number, _read(spark, f"{log}/{name}")) for number, name in sorted(names)]


def last(spark: SparkSession, log: str) -> tuple[int, dict | None]:
    """Number and content of the newest commit; (0, None) before the first."""
    numbers = [int(m.group(1)) for n in folders(spark, log) if (m := re.fullmatch(r"(\d+)\.json", n))]
    return (max(numbers), _read(spark, f"{log}/{max(numbers):08d}.json")) if numbers else (0, None)


def commit(spark: SparkSession, log: str, number: int, entry: dict) -> None:
    """Write commit ``number``; raises ``ConflictError`` when it exists already."""
    fs, target = file_system(spark, f"{log}/{number:08d}.json")
    _, own = file_system(spark, f"{log}/_{uuid.uuid4().hex}")
    stream = fs.create(own)
    stream.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
    stream.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.FileContext.getFileContext(fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    never = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    never[0] = jvm.Options.Rename.NONE                      # an existing target is not replaced
    try:
        files.rename(fs.makeQualified(own), fs.makeQualified(target), never)
    except Exception as e:  # noqa: BLE001  (py4j wraps Java's FileAlreadyExistsException)
        fs.delete(own, False)
        if fs.exists(target):
            raise ConflictError(f"{log}: commit {number} is taken") from e
        raise
