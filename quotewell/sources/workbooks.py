"""Workbooks as a Spark source: spark.read.format("workbook_rows"), for sheets too large to be one value.

Options: path (a folder or a file, local or a URI that Arrow's file systems know), headers (a JSON list: the sheet's header), pattern (of file names), bytes (of files that one partition
reads, unless a single one is larger). The schema is that of readers.workbook_cells: path, error, cells, a row a sheet row; a file that can't be read gives one row with its error and no other.

A task opens its files by path and reads them piece by piece: what it holds is a batch of rows, and the workbook's own table of strings as plain bytes. A file of more than one batch is
read twice, first to see that it is sound. The driver lists names and sizes only. A task that is run again reads its files again. No folder, or no file: no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quotewell.sources.readers import CELLS, WORKBOOKS, WorkbookContract, cell_batches


@dataclass
class Files(InputPartition):
    """Paths on the store of the option path."""

    paths: list[str]


def dealt(files: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Paths of (path, size) in order, in lists of at most so many bytes; a larger file has a list of its own."""
    out, held = [], 0
    for path, size in files:
        if not out or held + size > most:
            out.append([])
            held = 0
        out[-1].append(path)
        held += size
    return out


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.headers = options["path"], tuple(json.loads(options["headers"]))
        self.pattern, self.bytes = options.get("pattern", WORKBOOKS), int(options.get("bytes", 32 << 20))

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if re.match(r"^[a-z][a-z0-9+.-]*:", self.path) else (fs.LocalFileSystem(), self.path)

    def partitions(self) -> list[Files]:
        store, root = self._store()
        at = store.get_file_info(root)
        found = [at] if at.is_file else store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        wanted = sorted((x.path, x.size or 0) for x in found if x.is_file and re.search(self.pattern, x.base_name))
        return [Files(x) for x in dealt(wanted, self.bytes)] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = self._store()
        for path in partition.paths:
            with store.open_input_file(path) as f:
                yield from cell_batches(path, f, self.headers)


class WorkbookRows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook_rows"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema: object) -> WorkbookReader:
        return WorkbookReader(dict(self.options))


def large_workbook_cells(spark: SparkSession, folder: str, contract: WorkbookContract, pattern: str = WORKBOOKS) -> DataFrame:
    """As readers.workbook_cells, by this source: price_workbooks, index_workbooks and workbook_faults take either."""
    register(spark)
    return spark.read.format("workbook_rows").option("headers", json.dumps(contract.headers)).option("pattern", pattern).load(folder)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(WorkbookRows)
