"""Rows by their place in files, to pick or drop rows of a table of texts without shuffling the texts.

A row of a Parquet table is known by its file and its number there. What is decided about a row elsewhere, with small
keys, is written to a shelf: a folder of lists with one for each file. The next pass over the texts reads the list of
each file it meets. A place doesn't depend on how files are split, so the passes may differ in their tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, scratch_path, small_batches, stored

#: Plans that keep rows and places of the scan below them.
_ROW_BY_ROW = ("Project", "Filter", "SubqueryAlias", "View")


def in_files(docs: DataFrame) -> DataFrame:
    """``docs`` if it is read row by row from Parquet files, else a stored copy that is."""
    plan = docs._jdf.queryExecution().analyzed()
    steady = plan.deterministic()
    while plan.getClass().getSimpleName() in _ROW_BY_ROW:
        plan = plan.children().apply(0)
    parquet = plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation" and "Parquet" in plan.relation().fileFormat().getClass().getSimpleName()
    return docs if steady and parquet else stored(docs, "rows")


def place_of(docs: DataFrame) -> tuple[Column, Column]:
    """A hash of the file and the number in the file of each row of ``in_files(docs)``."""
    meta = docs.metadataColumn("_metadata")
    return F.xxhash64(meta.getField("file_path")), meta.getField("row_index")


def shelve(lists: DataFrame, label: str, texts: bool = False) -> str:
    """Writes rows with ``file`` and ``row`` and other columns, sorted by row in a list for each file; its path.

    ``texts`` is that of :func:`framelens.llm.common.stored`.
    """
    path = scratch_path(lists.sparkSession, label)
    with small_batches(lists.sparkSession) if texts else nullcontext():
        lists.repartition("file").sortWithinPartitions("file", "row").write.partitionBy("file").parquet(path)
    return path


class Shelf:
    """Reads the lists of a shelf, remembering that of the last file."""

    def __init__(self, path: str) -> None:
        self.store, self.base = arrow_fs.FileSystem.from_uri(path)
        self.file, self.list = None, None

    def of(self, file: int) -> pa.Table | None:
        if file != self.file:
            found = self.store.get_file_info(arrow_fs.FileSelector(f"{self.base}/file={file}", allow_not_found=True))
            parts = [pq.ParquetFile(self.store.open_input_file(x.path)).read() for x in found if x.base_name.endswith(".parquet")]
            self.file, self.list = file, pa.concat_tables(parts).sort_by("row") if parts else None
        return self.list

    def met(self, files: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, pa.Table]]:
        """For the rows of a batch: which of them are listed, and their entries in the same order. A row has one entry."""
        edges = np.flatnonzero(np.r_[True, files[1:] != files[:-1]]) if len(files) else []
        for a, b in zip(edges, [*edges[1:], len(files)]):
            entries = self.of(int(files[a]))
            if entries is None:
                continue
            listed = entries["row"].to_numpy()
            at = np.minimum(np.searchsorted(listed, rows[a:b]), len(listed) - 1)
            here = np.flatnonzero(listed[at] == rows[a:b])
            if len(here):
                yield a + here, entries.take(pa.array(at[here]))


def without(docs: DataFrame, path: str) -> DataFrame:
    """The rows of ``in_files(docs)`` that are not on the shelf."""
    file, row = place_of(docs)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf = Shelf(path)
        for batch in batches:
            stays = np.ones(batch.num_rows, bool)
            for listed, _ in shelf.met(batch.column(batch.num_columns - 2).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()):
                stays[listed] = False
            kept = batch.filter(pa.array(stays))
            yield pa.RecordBatch.from_arrays(kept.columns[:-2], names=batch.schema.names[:-2])

    return docs.select("*", file.alias(free_name(docs, "file")), row.alias(free_name(docs, "row"))).mapInArrow(drop, docs.schema)
