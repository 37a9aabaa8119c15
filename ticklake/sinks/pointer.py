"""One small JSON file that says what readers see, replaced as a whole.

Jobs write new folders next to the old ones and then replace the pointer; readers resolve it
once and read the folders it names. A job that stops before the replace leaves readers what
they had. The replace is a rename that overwrites, which HDFS, viewfs and local file systems
do in one step; on a store without such a rename the pointer belongs into a catalogue.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from ticklake.sinks.keyed import exists


def _context(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, target, jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf), target.getFileSystem(conf)


def publish(spark: SparkSession, path: str, value: dict) -> None:
    """Replace the pointer at ``path``."""
    jvm, target, context, fs = _context(spark, path)
    new = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    overwrite = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(overwrite, 1)
    how[0] = overwrite.OVERWRITE
    context.rename(new, target, how)


def resolve(spark: SparkSession, path: str) -> dict | None:
    """What the pointer at ``path`` says; None if there is none yet."""
    if not exists(spark, path):
        return None
    jvm, target, _, fs = _context(spark, path)
    stream = fs.open(target)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through its own file system."""
    _, target, _, fs = _context(spark, path)
    fs.delete(target, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The folders right below ``path`` (none if it is absent)."""
    if not exists(spark, path):
        return []
    _, target, _, fs = _context(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(target) if s.isDirectory()]
