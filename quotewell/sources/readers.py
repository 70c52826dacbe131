"""Sources: Parquet under contract, snapshots, run logs, workbooks, CSV results. All through Spark's readers, so that any store will do."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched, groupby, islice
from typing import BinaryIO
from xml.etree.ElementTree import Element, XMLPullParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.functions.exprs import c
from quotewell.functions.scalars import serial_to_date, split_security
from quotewell.plans.warehouse import Warehouse
from quotewell.sources import schemas, versions


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob has files, in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return bool(found) and len(found) > 0


def partitioned(spark: SparkSession, root: str, contract: T.StructType) -> DataFrame:
    """A processed dataset with its year and month folders; empty if it is not there yet."""
    if versions.newest(spark, root) is not None:
        return versions.read(spark, root, contract)
    whole = T.StructType([*contract.fields, *(T.StructField(n, T.IntegerType()) for n in ("year", "month") if n not in contract.names)])
    return spark.read.schema(whole).parquet(root) if exists(spark, root) else spark.createDataFrame([], whole)


def single(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """A table without folders of its own, versioned or plain; empty if it is not there yet."""
    if versions.newest(spark, path) is not None:
        return versions.read(spark, path, contract, by=())
    return spark.read.schema(contract).parquet(path) if exists(spark, path) else spark.createDataFrame([], contract)


def snapshots(spark: SparkSession, folder: str, contract: T.StructType) -> DataFrame:
    """All snapshots of a dimension as one table; columns that older files lack are null, and types are brought to the contract's."""
    if not exists(spark, folder):
        return spark.createDataFrame([], contract)
    return schemas.coerce(spark.read.option("mergeSchema", "true").parquet(folder), contract)


def latest_snapshot(spark: SparkSession, folder: str, contract: T.StructType) -> DataFrame:
    """The newest snapshot: that whose file name is largest."""
    rows = spark.read.schema(contract).parquet(folder).withColumn("_file", c("_metadata.file_name"))
    newest = rows.agg(F.max("_file").alias("_file"))
    return rows.join(F.broadcast(newest), "_file").drop("_file")


def run_log(spark: SparkSession, glob: str) -> DataFrame:
    """One JSON object a line. The schema is declared: metrics differ from job to job and stay text."""
    return spark.read.schema(schemas.RUN).json(glob) if exists(spark, glob) else spark.createDataFrame([], schemas.RUN)


def csv_results(spark: SparkSession, path: str) -> DataFrame:
    """A result saved by sinks.save_csv(): headed, UTF-8 with or without a byte order mark."""
    rows = spark.read.option("header", True).csv(path)
    return rows.toDF(*(n.removeprefix("﻿") for n in rows.columns))


def feather(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Arrow files (Feather) under a contract; to be converted to Parquet once, as Spark cannot split or prune them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import feather as arrow

        for batch in batches:
            for content in batch["content"]:
                table = arrow.read_table(pa.BufferReader(content.as_py()))
                columns = [table[n].cast(k) if n in table.column_names else pa.nulls(len(table), k) for n, k in zip(names, kinds, strict=True)]
                yield from pa.table(columns, names=names).combine_chunks().to_batches()

    from pyspark.sql.pandas.types import to_arrow_type

    names, kinds = contract.names, [to_arrow_type(f.dataType) for f in contract]
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, contract)


def held_dates(rows: DataFrame) -> DataFrame:
    """The days that a dataset has rows of."""
    return rows.select("date").where("date IS NOT NULL").distinct()


# --- workbooks --------------------------------------------------------------------------------------------------------


#: Names of workbooks that are no lock files.
WORKBOOKS = r"^[^~].*\.xlsx$"
CELLS = "path string, error string, cells array<string>"
#: Sheet rows of one batch.
ROWS_AT_ONCE = 2_048


@dataclass(frozen=True)
class WorkbookContract:
    """Columns of a sheet in order: (header, name). Names security, index, date and constituent are identities; those in text and whole are typed so."""

    columns: tuple[tuple[str, str], ...]
    text: frozenset[str] = frozenset()
    whole: frozenset[str] = frozenset()
    identities: tuple[str, ...] = ("security", "date")

    @property
    def headers(self) -> tuple[str, ...]:
        return tuple(h for h, _ in self.columns)


def column_number(reference: str) -> int:
    """A1 -> 0, AC12 -> 28."""
    n = 0
    for ch in reference:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _local(tag: str) -> str:
    """A tag without its namespace: transitional and strict workbooks differ in nothing else here."""
    return tag.rpartition("}")[2]


def _texts(node: Element) -> str:
    """All text below a string item or an inline string, but for phonetic hints."""
    if _local(node.tag) == "rPh":
        return ""
    return (node.text or "") * (_local(node.tag) == "t") + "".join(map(_texts, node))


def _events(z: zipfile.ZipFile, part: str, forget: str | None = None) -> Iterator[tuple[str, str, Element]]:
    """(start or end, local tag, node) of a part, read piece by piece. Nodes with the tag forget leave the tree once they have been told, so that it stays small."""
    parser, above = XMLPullParser(("start", "end")), []
    with z.open(part) as f:
        while piece := f.read(1 << 16):
            parser.feed(piece)
            for event, node in parser.read_events():
                tag = _local(node.tag)
                if event == "start":
                    above.append(node)
                else:
                    above.pop()
                yield event, tag, node
                if event == "end" and tag == forget and above:
                    above[-1].remove(node)
    parser.close()  # raises if the part ends too early


class _Strings:
    """A workbook's table of strings in two flat buffers: eight bytes a string beside its text, however many there are."""

    def __init__(self) -> None:
        self.text, self.ends = bytearray(), array("Q", [0])

    def append(self, text: str) -> None:
        self.text += text.encode()
        self.ends.append(len(self.text))

    def __getitem__(self, k: int) -> str:
        if not 0 <= k < len(self.ends) - 1:
            raise ValueError(f"no string number {k}")
        return self.text[self.ends[k] : self.ends[k + 1]].decode()


def sheet_cells(content: bytes | BinaryIO) -> Iterator[tuple[int, int, str]]:
    """(row, column, text) of the first sheet's cells that have a value, counted from 0. Rows and cells without a reference follow the one before.

    content: a workbook, or an open file of it. Of the sheet, a row at a time is held, beside the workbook's table of strings."""
    with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as z:
        strings = _Strings()
        if "xl/sharedStrings.xml" in z.namelist():
            for event, tag, node in _events(z, "xl/sharedStrings.xml", forget="si"):
                if (event, tag) == ("end", "si"):
                    strings.append(_texts(node))
        row = column = -1
        for event, tag, node in _events(z, "xl/worksheets/sheet1.xml", forget="row"):
            if tag == "row":
                if event == "start":
                    row, column = int(node.get("r", row + 2)) - 1, -1
            elif tag == "c" and event == "start":
                column = column_number(node.get("r")) if node.get("r") else column + 1
            elif tag == "c":
                kind, value = node.get("t"), next((x.text for x in node if _local(x.tag) == "v"), None)
                text = "".join(_texts(x) for x in node if _local(x.tag) == "is") if kind == "inlineStr" else strings[int(value)] if kind == "s" and value is not None else value
                if text is not None:
                    yield row, column, text


def sheet_rows(content: bytes | BinaryIO, width: int) -> Iterator[list[str | None]]:
    """The first sheet's rows that have values, as lists of width texts."""
    for _, cells in groupby(sheet_cells(content), key=lambda x: x[0]):
        found = {column: text for _, column, text in cells}
        yield [found.get(k) for k in range(width)]


def header_faults(got: list[str | None], expected: tuple[str, ...]) -> list[str]:
    """The first five differences from a contract's header."""
    seen = [(h or "").strip() for h in got]
    return [f"column {i + 1}: expected {e!r}, got {g!r}" for i, (e, g) in enumerate(zip(expected, seen, strict=True)) if e != g][:5]


def checked_rows(content: bytes | BinaryIO, headers: tuple[str, ...], at_once: int = ROWS_AT_ONCE) -> Iterator[list[list[str | None]]]:
    """The rows below a sheet's header in lists of at_once at most. What is wrong with a file is raised before any of its rows: one of more rows is read through before they are told."""
    rows = sheet_rows(content, len(headers))
    first = next(rows, None)
    if first is None:
        raise ValueError("empty sheet")
    if faults := header_faults(first, headers):
        raise ValueError("unexpected header: " + "; ".join(faults))
    told = list(islice(rows, at_once))
    if next(rows, None) is None:  # those were all
        if told:
            yield told
        return
    del told
    for _ in rows:
        pass
    yield from map(list, batched(islice(sheet_rows(content, len(headers)), 1, None), at_once))


def cell_batches(path: str, content: bytes | BinaryIO, headers: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """path, error, cells of one workbook: its rows in bounded batches, or a single row with the error."""

    def told(cells: list[list[str | None] | None], error: str | None) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(cells)), pa.array([error] * len(cells), pa.string()), pa.array(cells, pa.list_(pa.string()))], ["path", "error", "cells"])

    batches = checked_rows(content, headers)
    try:
        first = next(batches, None)
    except Exception as e:  # noqa: BLE001  one bad file must not hide the others
        yield told([None], f"{type(e).__name__}: {e}")
        return
    if first is not None:
        yield told(first, None)
        yield from (told(rows, None) for rows in batches)


def workbook_cells(spark: SparkSession, folder: str, contract: WorkbookContract, pattern: str = WORKBOOKS) -> DataFrame:
    """path, error, cells: a row a sheet row, or a row with an error for a file that can't be read. Only unzipping runs in Python, a file at a time; Spark hands each file over as one
    value, so for files of over some hundred MB see sources/workbooks.py."""
    headers = contract.headers

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                yield from cell_batches(path, content.as_py(), headers)

    if not exists(spark, folder):
        return spark.createDataFrame([], CELLS)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    wanted = files.where(F.element_at(F.split("path", "/"), -1).rlike(pattern)).select("path", "content")
    return wanted.mapInArrow(parse, CELLS)


def assert_not_busy(spark: SparkSession, folder: str) -> None:
    """Refuse to read while a spreadsheet program holds a file: it leaves a lock file beside it."""
    if exists(spark, f"{folder}/~$*") or exists(spark, f"{folder}/*/~$*"):
        raise RuntimeError(f"workbooks in {folder} are open elsewhere")


def _values(contract: WorkbookContract) -> list[F.Column]:
    out = []
    for k, (_, name) in enumerate(contract.columns):
        if name not in contract.identities:
            cell = F.get("cells", F.lit(k))
            out.append((F.when(cell != "", cell) if name in contract.text else cell.try_cast("double").cast("bigint") if name in contract.whole else cell.try_cast("double")).alias(name))
    return out


def _cell(contract: WorkbookContract, name: str) -> F.Column:
    return F.get("cells", F.lit([n for _, n in contract.columns].index(name)))


def price_workbooks(cells: DataFrame, contract: WorkbookContract, ingested_at: dt.datetime) -> DataFrame:
    """Bars from workbook cells, one security a file: see also workbook_faults()."""
    stock_id, stock_name = split_security(_cell(contract, "security"))
    day = serial_to_date(_cell(contract, "date").cast("double"))
    rows = cells.where(c("error").isNull() & _cell(contract, "security").isNotNull() & _cell(contract, "date").isNotNull())
    return rows.select(stock_id.alias("stock_id"), stock_name.alias("stock_name"), day.alias("date"), *_values(contract), F.element_at(F.split("path", "/"), -1).alias("source_file"), F.lit(ingested_at).alias("ingested_at"))


def index_workbooks(cells: DataFrame, contract: WorkbookContract, ingested_at: dt.datetime) -> DataFrame:
    """Constituents from workbook cells. Rows without a constituent are prompts that nobody answered, and go."""
    (index_id, index_name), (stock_id, stock_name) = split_security(_cell(contract, "index")), split_security(_cell(contract, "constituent"))
    answered = [_cell(contract, n).isNotNull() for n in ("index", "date", "constituent")]
    rows = cells.where(c("error").isNull() & answered[0] & answered[1] & answered[2])
    file = F.array_join(F.slice(F.split("path", "/"), -2, 2), "/")
    return rows.select(
        index_id.alias("index_id"), index_name.alias("index_name"), serial_to_date(_cell(contract, "date").cast("double")).alias("date"), stock_id.alias("stock_id"), stock_name.alias("stock_name"),
        *_values(contract), file.alias("source_file"), F.lit(ingested_at).alias("ingested_at"),
    )


def workbook_faults(cells: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """source_file, error: files that can't be read, and files with more than one security (index)."""
    unread = cells.where(c("error").isNotNull()).select(F.element_at(F.split("path", "/"), -1).alias("source_file"), "error")
    mixed = rows.groupBy("source_file").agg(F.sort_array(F.collect_set(key)).alias("ids")).where(F.size("ids") > 1)
    return unread.unionByName(mixed.select("source_file", F.concat(F.lit("expected one, found "), F.array_join("ids", ", ")).alias("error")))


def workbook_inventory(spark: SparkSession, folder: str, table: str, fields: tuple[str, ...], scanned_at: dt.datetime) -> DataFrame:
    """A row a workbook: size, sheet, declared block, and whether its stored query is the contract's. An odd query is told, not refused."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [scan_container(x.as_py(), table, fields) for x in batch["content"]]
            names = ("sheet_name", "defined_name", "defined_range", "declared_rows", "vendor_table", "vendor_field_count", "descending", "query_matches_contract")
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["source_file"], batch["file_bytes"], batch["modified_at"], *(pa.array([t[n] for t in told], k) for n, k in zip(names, kinds, strict=True))], ["source_file", "file_bytes", "modified_at", *names])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(folder)
    own = files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), c("length").alias("file_bytes"), c("modificationTime").alias("modified_at"), "content").where(~c("source_file").startswith("~$"))
    kind = "source_file string, file_bytes bigint, modified_at timestamp, sheet_name string, defined_name string, defined_range string, declared_rows bigint, vendor_table string, vendor_field_count bigint, descending boolean, query_matches_contract boolean"
    return own.mapInArrow(scan, kind).withColumn("scanned_at", F.lit(scanned_at))


def _first(z: zipfile.ZipFile, part: str, wanted: str) -> Element | None:
    return next((node for event, tag, node in _events(z, part) if (event, tag) == ("end", wanted)), None) if part in z.namelist() else None


def scan_container(content: bytes, table: str, fields: tuple[str, ...]) -> dict[str, object]:
    """What a workbook's container says of itself; what it does not say is None. The stored query is a note: settings, key=value, closed by ###."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        sheet, block, note = _first(z, "xl/workbook.xml", "sheet"), _first(z, "xl/workbook.xml", "definedName"), _first(z, "xl/comments1.xml", "comments")
    area = (block.text or "").strip() if block is not None else None
    last_row = area.rpartition("$")[2] if area else ""
    settings = dict(x.split("=", 1) for x in ("".join(note.itertext()) if note is not None else "").split("###") if "=" in x)
    asked, _, rest = {k.strip(): v.strip() for k, v in settings.items()}.get("tSearchString", "").partition("|||")
    own = [x.strip() for x in rest.partition("|||")[0].split(",")] if rest else []
    return {
        "sheet_name": sheet.get("name") if sheet is not None else None, "defined_name": block.get("name") if block is not None else None, "defined_range": area,
        "declared_rows": int(last_row) - 1 if last_row.isdigit() else None, "vendor_table": asked.strip() or None, "vendor_field_count": len(own) or None,
        "descending": any(k.strip() == "tDesc" and v.strip() == "1" for k, v in settings.items()), "query_matches_contract": asked.strip() == table and tuple(own) == fields,
    }


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """The warehouse below a folder: processed/<dataset> with year and month folders, single tables, and logs/runs."""
    at = lambda name: f"{root}/processed/{name}"
    bars = {"feed_bars": ("daily-prices", schemas.PRICE), "feed_adj_bars": ("adj-daily-prices", schemas.PRICE), "vendor_bars": ("vendor-prices", schemas.VENDOR_PRICE)}
    months = {f"{name}@newest": versions.newest_month(spark, at(folder), contract) for name, (folder, contract) in bars.items()}
    return Warehouse(
        spark,
        {name: rows for name, rows in months.items() if rows is not None} | {
            "feed_bars": partitioned(spark, at("daily-prices"), schemas.PRICE), "feed_adj_bars": partitioned(spark, at("adj-daily-prices"), schemas.PRICE), "feed_calendar": single(spark, at("trading-dates"), schemas.CALENDAR),
            "feed_stock_info": single(spark, at("stock-info"), schemas.STOCK_INFO), "feed_delisted": single(spark, at("delisted-securities"), schemas.DELISTED), "feed_industry": single(spark, at("industry"), schemas.INDUSTRY),
            "feed_known_empty": single(spark, at("known-empty-dates"), schemas.KNOWN_EMPTY), "feed_runs": run_log(spark, f"{root}/logs/feed/*.jsonl"), "vendor_runs": run_log(spark, f"{root}/logs/vendor/*.jsonl"),
            "feed_raw_ticker": snapshots(spark, f"{root}/raw/adj-ticker", schemas.RAW_PRICE), "feed_raw_market": snapshots(spark, f"{root}/raw/adj-market", schemas.RAW_PRICE),
            "vendor_bars": partitioned(spark, at("vendor-prices"), schemas.VENDOR_PRICE), "index_rows": partitioned(spark, at("index-constituents"), schemas.INDEX_ROW),
            "vendor_workbooks": single(spark, at("workbooks"), schemas.WORKBOOK_SCAN), "vendor_index_workbooks": single(spark, at("index-workbooks"), schemas.INDEX_WORKBOOK_SCAN),
        },
    )
