"""Small text files, a folder each, where the shared folder is mounted on every machine.

Hadoop's local file system starts a process (`chmod`) for each folder and file that it makes, and Spark lists
the files on the driver. On mounted folders tasks do both themselves; `mounted` is None for any other place, and
Spark's own writers and readers serve it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
from collections.abc import Iterator
from fnmatch import fnmatchcase
from urllib.parse import quote

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import small_batches

# Functions travel to the workers with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes and files of an Arrow batch that a reading task gives at once.
BATCH_BYTES, BATCH_FILES = 4 << 20, 512
#: Names of folders that the listing task gives at once.
LISTED = 10_000
_PACKED = ("bz2", "deflate", "gz", "lz4", "snappy", "zst")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# What Spark escapes in the names of partition folders, and what Java escapes in the path of a URI.
_IN_FOLDER = r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]"""
_IN_URI = r"""[\x00-\x20\x7f-\xa0"#%<>?\[\\\]^`{|}\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"""


def mounted(spark: SparkSession, path: str) -> str | None:
    """The plain path, if tasks can open it as it is."""
    if found := re.fullmatch(r"file:(?://)?(/[^/].*)", path):
        return found[1]
    if not re.match(r"/[^/]", path):
        return None
    default = spark._jsparkSession.sessionState().newHadoopConf().get("fs.defaultFS")
    return path if default.startswith("file:") else None


def _escaped(name: str) -> str:
    return re.sub(_IN_FOLDER, lambda m: f"%{ord(m[0]):02X}", name)


def write_folders(df: DataFrame, path: str, by: str) -> None:
    """The other column as lines of text, in a folder `by=...` for each value: the files of ``partitionBy(by).text``."""
    (value,) = (c for c in df.columns if c != by)
    top = mounted(df.sparkSession, path)
    if top is None:
        # Tasks put their own files in place, the driver does not move them one by one.
        own = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
        return df.write.options(**own).partitionBy(by).text(path)
    small_batches(df.sparkSession)
    os.makedirs(top)
    run = uuid.uuid4().hex

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        file = f"part-{TaskContext.get().partitionId():05d}-{run}.txt"
        attempt = f".{file}.{TaskContext.get().taskAttemptId()}"

        def put(name, lines):
            folder = f"{top}/{_escaped(by)}={_escaped(name)}"
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/{attempt}", "wb") as out:
                out.writelines(lines)
            # A task that runs twice replaces its file by the same one.
            os.replace(f"{folder}/{attempt}", f"{folder}/{file}")

        now, lines, n = None, [], 0
        for batch in batches:
            for name, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if lines and name != now:
                    put(now, lines)
                    lines, n = [], n + 1
                now = name
                lines.append((line or b"") + b"\n")
        if lines:
            put(now, lines)
            n += 1
        yield pa.record_batch({"n": pa.array([n], pa.int64())})

    name = F.coalesce(F.nullif(F.col(by).cast("string"), F.lit("")), F.lit(_NO_VALUE))
    rows = df.select(name.alias("name"), F.col(value).cast("binary").alias("line"))
    rows.sortWithinPartitions("name").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _parts(pattern: str) -> tuple[str, list[str]] | None:
    """The folder above the first wildcard, and the names below; None if Hadoop's and our wildcards may differ."""
    pattern = re.sub("/+", "/", pattern)
    last = re.search(r"[^/]\.(\w+)\Z", pattern)
    if not last or last[1] in _PACKED or re.search(r"[\[\]{}\\,]|/\.{1,2}/", pattern):
        return None
    names = pattern.split("/")
    first = next((i for i, name in enumerate(names) if re.search(r"[*?]", name)), len(names) - 1)
    return "/".join(names[:first]), names[first:]


def _level(folder: str, names: list[str]) -> Iterator[str]:
    """What fits the first name: folders if more names follow, else files. Spark's readers pass over hidden files, too."""
    with os.scandir(folder) as found:
        for entry in found:
            if not fnmatchcase(entry.name, names[0]):
                continue
            if entry.is_dir() if names[1:] else entry.is_file() and not re.match(r"\.|_(?!.*=)|.*\._COPYING_\Z", entry.name):
                yield entry.name


def _files(folder: str, names: list[str]) -> Iterator[str]:
    if not names:
        yield folder
        return
    for name in _level(folder, names):
        yield from _files(f"{folder}/{name}", names[1:])


def _page(file: str) -> str:
    """The folder's name, as `input_file_name` has it."""
    return re.sub(_IN_URI, lambda m: quote(m[0], safe=""), file.split("/")[-2])


def _utf8(value: bytes) -> bytes | None:
    """A JSON text in UTF-8; None if it has no valid encoding."""
    try:
        return value.decode(json.detect_encoding(value)).encode()
    except UnicodeDecodeError:
        return None


def read_folders(spark: SparkSession, pattern: str, is_json: bool = False) -> DataFrame | None:
    """(page, value) of all files that are not empty: the folder's name and the text as bytes.

    One task lists the folders, all of them list and read what lies in these. None if Spark's readers have to do it.
    """
    path = mounted(spark, pattern)
    found = path and _parts(path)
    # Where there is no file at all, Spark's readers say so.
    if not found or not os.path.isdir(found[0]) or next(_files(*found), None) is None:
        return None
    top, names = found

    def listed(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            some = []
            for name in _level(top, names):
                some.append(name)
                if len(some) >= LISTED:
                    yield pa.record_batch({"name": pa.array(some, pa.string())})
                    some = []
            yield pa.record_batch({"name": pa.array(some, pa.string())})

    def read(batches):
        import pyarrow as pa

        def batch_of(rows):
            pages, values = zip(*rows, strict=True)
            return pa.record_batch({"page": pa.array(pages, pa.string()), "value": pa.array(values, pa.binary())})

        rows, size = [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for file in _files(f"{top}/{name}", names[1:]):
                    with open(file, "rb") as source:
                        value = source.read()
                    if not value:
                        continue
                    rows.append((_page(file), _utf8(value) if is_json else value))
                    size += len(value)
                    if size >= BATCH_BYTES or len(rows) >= BATCH_FILES:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    tasks = 3 * spark.sparkContext.defaultParallelism
    folders = spark.range(0, 1, 1, 1).mapInArrow(listed, "name string").repartition(tasks, "name")
    return folders.mapInArrow(read, "page string, value binary")
