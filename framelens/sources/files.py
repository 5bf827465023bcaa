"""Text files in large numbers: one for each name, written and read by tasks through Arrow's file systems."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files and bytes of texts that one batch hands on.
_BATCH_FILES, _BATCH_BYTES = 1_000, 1 << 23
#: Characters that Spark escapes in names of folders, and those that it quotes in paths of files.
_ESCAPED = re.compile(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]""")
_QUOTED = re.compile(r'[\x00-\x20\x7f%"<>\\^`{|}#?\[\]]')


def _percent(found: re.Match) -> str:
    return f"%{ord(found[0]):02X}"


def store_of(name: str) -> tuple[arrow_fs.FileSystem, str, str]:
    """The store of a path, the place in it, and what stands before a place in a name."""
    name = re.sub(r"^file:/*", "/", name)
    if "://" not in name:
        return arrow_fs.LocalFileSystem(), os.path.abspath(name), "file:"
    store, place = arrow_fs.FileSystem.from_uri(name)
    return store, place, name.rstrip("/").removesuffix(place.rstrip("/"))


def _made(path: str, mode: str) -> bool:
    """Makes the folder as the mode has it; whether it is to be written."""
    store, place, _ = store_of(path)
    exists = store.get_file_info(place).type != arrow_fs.FileType.NotFound
    if mode not in ("error", "errorifexists", "ignore", "overwrite", "append"):
        raise ValueError(f"{mode!r} is no mode")
    if exists and mode == "ignore":
        return False
    if exists and mode in ("error", "errorifexists"):
        raise FileExistsError(path)
    if exists and mode == "overwrite":
        store.delete_dir(place)
    store.create_dir(place)
    return True


def write_texts(lines: DataFrame, name: str, path: str, mode: str = "error") -> None:
    """The lines (``value``) of each value of the column ``name`` as the file ``<name>=<value>.txt``.

    Files stand in a folder for each of the shuffle's partitions. Odd characters of a value are percent-encoded, and null is
    ``__HIVE_DEFAULT_PARTITION__``, as in Spark's folders. Further lines of a value that are appended later are a further
    file of that name. A file appears under its name when it is whole, so a task may be repeated.
    """
    if not _made(path, mode):
        return
    parts, run = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), uuid.uuid4().hex[:12]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place, _ = store_of(path)
        folder, attempt = f"{place}/slice={run}-{TaskContext.get().partitionId():05d}", uuid.uuid4().hex
        at, out, count = None, None, 0

        def close() -> None:
            out.close()
            store.move(f"{folder}/.{attempt}", f"{folder}/{at}")

        for batch in batches:
            for value, line in zip(*(c.to_pylist() for c in batch.columns)):
                file = f"{name}={_ESCAPED.sub(_percent, value)}.txt"
                if file != at:
                    if out is None:
                        store.create_dir(folder)
                    else:
                        close()
                    at, out, count = file, store.open_output_stream(f"{folder}/.{attempt}"), count + 1
                out.write((line or "").encode() + b"\n")
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["n"])

    named = lines.select(F.coalesce(F.col(name).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("name"), F.col("value").cast("string").alias("value"))
    named.repartition(parts, "name").sortWithinPartitions("name").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def write_lists(records: DataFrame, names: list[str], path: str, mode: str = "error") -> None:
    """A file ``part=<part>-<run>.json`` for each ``part`` of the records: one JSON document of lists under the names, the list
    of a name being the JSON texts (``record``) of the rows whose ``section`` is its place among them.

    Records come sorted and pass one by one, so no document stands in memory, however large. Odd characters of a part, null
    and repeated tasks are as in :func:`write_texts`; a further run that appends writes further files.
    """
    if not _made(path, mode):
        return
    run = uuid.uuid4().hex[:12]
    heads = [("{" if i == 0 else "],") + json.dumps(n) + ":[" for i, n in enumerate(names)]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place, _ = store_of(path)
        attempt, at, section, out, count = uuid.uuid4().hex, None, -1, None, 0

        def close() -> None:
            out.write(("".join(heads[section + 1 :]) + "]}\n").encode())
            out.close()
            store.move(f"{place}/.{attempt}", f"{place}/part={_ESCAPED.sub(_percent, at)}-{run}.json")

        for batch in batches:
            for part, number, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
                if part != at:
                    if out is not None:
                        close()
                    at, section, out, count = part, -1, store.open_output_stream(f"{place}/.{attempt}", buffer_size=1 << 20), count + 1
                if number == section:
                    out.write(b"," + record)
                else:
                    out.write("".join(heads[section + 1 : number + 1]).encode() + record)
                    section = number
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["n"])

    dealt = records.select(F.coalesce(F.col("part").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("part"), "section", "record")
    dealt.repartition("part").sortWithinPartitions("part", "section").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _shown(file: arrow_fs.FileInfo) -> bool:
    """Whether Spark's readers would take a file or folder of this name."""
    return not (file.base_name.startswith(".") or file.base_name.startswith("_") and "=" not in file.base_name)


def read_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path and value (the whole text) of each file in and below a folder, or of the file itself.

    The driver lists the folder alone; what stands in its folders is listed and read by tasks. Paths with wildcards and
    those of stores that Arrow doesn't know are read by Spark.
    """
    names = [path] if isinstance(path, str) else list(path)
    try:
        if any(re.search(r"[*?\[{]", n) for n in names):
            raise ValueError("a wildcard")
        stores = [store_of(n) for n in names]
    except (ValueError, NotImplementedError, OSError):
        return spark.read.text(names, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), "value")
    units = []
    for number, (store, place, _) in enumerate(stores):
        info = store.get_file_info(place)
        if info.type == arrow_fs.FileType.NotFound:
            raise FileNotFoundError(names[number])
        below = [info] if info.is_file else [f for f in store.get_file_info(arrow_fs.FileSelector(place)) if _shown(f)]
        units += [(number, f.path, f.type == arrow_fs.FileType.Directory) for f in below]
    kinds = (pa.int32(), pa.string(), pa.bool_())
    listed = pa.table([pa.array([u[i] for u in units], t) for i, t in enumerate(kinds)], names=["number", "place", "folder"])
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        found, size = [], 0
        for batch in batches:
            for number, place, folder in zip(*(c.to_pylist() for c in batch.columns)):
                if number not in known:
                    known[number] = store_of(names[number])
                store, _, before = known[number]
                todo = [(place, folder)]
                while todo:
                    here, folder = todo.pop()
                    if folder:
                        todo += [(f.path, f.type == arrow_fs.FileType.Directory) for f in store.get_file_info(arrow_fs.FileSelector(here)) if _shown(f)]
                        continue
                    with store.open_input_stream(here) as stream:
                        text = stream.read().decode("utf-8", "replace")
                    found.append((before + _QUOTED.sub(_percent, here), text))
                    size += len(text)
                    if len(found) >= _BATCH_FILES or size >= _BATCH_BYTES:
                        yield _texts(found)
                        found, size = [], 0
        yield _texts(found)

    return spark.createDataFrame(listed).repartition(tasks).mapInArrow(read, "path string, value string")


def _texts(found: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], names=["path", "value"])
