"""Small JSON files that appear whole or not at all, and numbered logs made of them.

A file is written beside its place and renamed, so a reader never meets half of one. Renaming onto
an existing name is refused, which is what makes an entry of a log belong to one writer: whoever
finds number n taken has to look at entry n before trying n + 1. HDFS and viewfs refuse atomically;
on a local disk the writers of one process also hold a lock.
"""

from __future__ import annotations

import json
import threading
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_lock = threading.Lock()
_DIGITS = 12


def _place(spark: SparkSession, path: str):
    """The path as the file system sees it, and its two Hadoop views."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(conf)
    place = fs.makeQualified(place)
    return place, fs, jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, bytes) of a folder's direct entries in order of name; none if it does not exist."""
    place, fs, _ = _place(spark, path)
    if not fs.exists(place):
        return []
    return sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(place))


def changed(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, time of the last change in seconds) of a folder's direct entries."""
    place, fs, _ = _place(spark, path)
    if not fs.exists(place):
        return []
    return sorted(
        (s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(place)
    )


def size_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Files and bytes under a path; (0, 0) if it does not exist."""
    place, fs, _ = _place(spark, path)
    if not fs.exists(place):
        return 0, 0
    found = fs.getContentSummary(place)
    return found.getFileCount(), found.getLength()


def delete(spark: SparkSession, path: str) -> None:
    place, fs, _ = _place(spark, path)
    fs.delete(place, True)


def get_json(spark: SparkSession, path: str) -> dict | None:
    """The file's content; None if there is no such file."""
    place, fs, _ = _place(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        return json.loads(bytes(io.toByteArray(stream)).decode())
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file, unpacked where its name says so."""
    place, fs, _ = _place(spark, path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = fs.open(place)
    try:
        opened = codec.createInputStream(stream) if codec is not None else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(opened, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def put_json(spark: SparkSession, path: str, content: dict, replace: bool = False) -> bool:
    """Write a file whole. Without ``replace``, False if the name is already taken."""
    place, fs, context = _place(spark, path)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(kind, 1)
    how[0] = kind.valueOf("OVERWRITE" if replace else "NONE")
    fs.mkdirs(place.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_aside-{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    finally:
        stream.close()
    try:
        with _lock:
            if not replace and fs.exists(place):
                return False
            context.rename(aside, place, how)
        return True
    except Py4JJavaError as err:
        if "FileAlreadyExists" in err.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(aside, False)


def entries(spark: SparkSession, log: str, after: int = 0) -> list[tuple[int, dict]]:
    """The log's entries behind number ``after``, in order."""
    names = [n for n, _ in children(spark, log) if n.endswith(".json") and n[:_DIGITS].isdigit()]
    numbers = sorted(int(n[:_DIGITS]) for n in names)
    return [(i, get_json(spark, _entry(log, i))) for i in numbers if i > after]


def append(spark: SparkSession, log: str, number: int, content: dict) -> bool:
    """Take entry ``number`` of a log; False if another writer has it."""
    return put_json(spark, _entry(log, number), content)


def _entry(log: str, number: int) -> str:
    return f"{log}/{number:0{_DIGITS}d}.json"
