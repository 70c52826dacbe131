"""Readers and sinks on small files."""

import datetime as dt
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from quotewell.operators.checks import storage_checks
from quotewell.sources import readers, schemas, sinks, versions

D = dt.date
NOW = dt.datetime(2026, 9, 5)
CONTRACT = readers.WorkbookContract((("Security", "security"), ("Day", "date"), ("Close", "close"), ("Trades", "transactions"), ("Flag", "limit_flag")), text=frozenset({"limit_flag"}), whole=frozenset({"transactions"}))
INDEX = readers.WorkbookContract((("Index", "index"), ("Day", "date"), ("Member", "constituent"), ("Weight", "prev_weight_pct")), identities=("index", "date", "constituent"))
SHEET = '<?xml version="1.0"?><x:worksheet xmlns:x="urn:any-namespace"><x:sheetData>%s</x:sheetData></x:worksheet>'


def book(path, rows, extra=None, inline=False):
    """A workbook whose strings are in its table of strings, or in the cells; None has no cell, so later ones need a reference."""
    table = sorted({v for row in rows for v in row if isinstance(v, str)})

    def cell(v, name):
        if not isinstance(v, str):
            return f'<x:c r="{name}"><x:v>{v}</x:v></x:c>'
        return f'<x:c r="{name}" t="inlineStr"><x:is><x:t>{v}</x:t></x:is></x:c>' if inline else f'<x:c r="{name}" t="s"><x:v>{table.index(v)}</x:v></x:c>'

    lines = ("".join(cell(v, f"{'ABCDEFGH'[k]}{n}") for k, v in enumerate(row) if v is not None) for n, row in enumerate(rows, 1))
    parts = {"xl/worksheets/sheet1.xml": SHEET % "".join(f'<x:row r="{n}">{x}</x:row>' for n, x in enumerate(lines, 1))}
    if not inline:
        parts["xl/sharedStrings.xml"] = "<sst>%s</sst>" % "".join(f"<si><r><t>{v[:1]}</t></r><r><t>{v[1:]}</t></r><rPh><t>hint</t></rPh></si>" for v in table)
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, text in (parts | (extra or {})).items():
            z.writestr(name, text)


def test_cells_without_references(tmp_path):
    book(tmp_path / "a.xlsx", [["x", 1], [None, 2.5], [], ["y"]], inline=True)
    assert list(readers.sheet_cells((tmp_path / "a.xlsx").read_bytes())) == [(0, 0, "x"), (0, 1, "1"), (1, 1, "2.5"), (3, 0, "y")]
    book(tmp_path / "b.xlsx", [], {"xl/worksheets/sheet1.xml": SHEET % "<x:row><x:c><x:v>1</x:v></x:c><x:c><x:v>2</x:v></x:c></x:row><x:row/><x:row><x:c r='C9'/><x:c><x:v>3</x:v></x:c></x:row>"})
    assert list(readers.sheet_rows((tmp_path / "b.xlsx").read_bytes(), 4)) == [["1", "2", None, None], [None, None, None, "3"]]


HEAD = ["Security", "Day", "Close", "Trades", "Flag"]


def test_price_workbooks(spark, tmp_path):
    book(tmp_path / "w/2330.xlsx", [HEAD, ["2330 Some Name", 36773, 133.5, 3324, None], ["2330 Some Name", 36774, None, 7, "+"], [None, None, None, None, None]])
    book(tmp_path / "w/bad.xlsx", [["Security", "Date", "Close", "Trades", "Flag"]])
    book(tmp_path / "w/two.xlsx", [HEAD, ["1 a", 36773, 1, 1, None], ["2 b", 36773, 1, 1, None]])
    (tmp_path / "w/torn.xlsx").write_bytes(b"no zip")
    (tmp_path / "w/~$2330.xlsx").write_bytes(b"lock")
    cells = readers.workbook_cells(spark, str(tmp_path / "w"), CONTRACT)
    rows = readers.price_workbooks(cells, CONTRACT, NOW)
    got = [tuple(r) for r in rows.where("source_file = '2330.xlsx'").orderBy("date").collect()]
    assert got == [("2330", "Some Name", D(2000, 9, 4), 133.5, 3324, None, "2330.xlsx", NOW), ("2330", "Some Name", D(2000, 9, 5), None, 7, "+", "2330.xlsx", NOW)]
    faults = {r.source_file: r.error for r in readers.workbook_faults(cells, rows, "stock_id").collect()}
    assert set(faults) == {"bad.xlsx", "two.xlsx", "torn.xlsx"} and "column 2: expected 'Day', got 'Date'" in faults["bad.xlsx"] and faults["two.xlsx"].endswith("1, 2")
    with pytest.raises(RuntimeError, match="open elsewhere"):
        readers.assert_not_busy(spark, str(tmp_path / "w"))
    assert readers.workbook_cells(spark, str(tmp_path / "none"), CONTRACT).isEmpty()


def test_index_workbooks_drop_prompts(spark, tmp_path):
    book(tmp_path / "i/TWN50/2026.xlsx", [["Index", "Day", "Member", "Weight"], ["TWN50 Big", 46272, None, None], ["TWN50 Big", 46269, "2330 Name", 5.5]])
    book(tmp_path / "i/TWN50/26-test.xlsx", [["x"]])
    cells = readers.workbook_cells(spark, str(tmp_path / "i"), INDEX, r"^\d{4}\.xlsx$")
    rows = readers.index_workbooks(cells, INDEX, NOW).collect()
    assert [(r.index_id, r.date, r.stock_id, r.prev_weight_pct, r.source_file) for r in rows] == [("TWN50", D(2026, 9, 4), "2330", 5.5, "TWN50/2026.xlsx")]


def test_inventory(spark, tmp_path):
    extra = {"xl/workbook.xml": '<workbook><sheets><sheet name="S"/><sheet name="T"/></sheets><definedNames><definedName name="grid">S!$A$1:$E$12</definedName></definedNames></workbook>', "xl/comments1.xml": "<comments><t>tSearchString=prices|||A, B###</t><t>tDesc=1###</t></comments>"}
    book(tmp_path / "w/1.xlsx", [HEAD], extra)
    book(tmp_path / "w/2.xlsx", [HEAD])
    got = {r.source_file: r for r in readers.workbook_inventory(spark, str(tmp_path / "w"), "prices", ("A", "B"), NOW).collect()}
    one, two = got["1.xlsx"], got["2.xlsx"]
    assert (one.sheet_name, one.declared_rows, one.vendor_field_count, one.descending, one.query_matches_contract) == ("S", 11, 2, True, True)
    assert (two.sheet_name, two.declared_rows, two.query_matches_contract) == (None, None, False) and one.file_bytes > 0


def bars(spark, *rows):
    return spark.createDataFrame([(d, i, 1.0, 1.0, 1.0, c, 0.0, 1, 1, 1, "ticker", NOW) for d, i, c in rows], schemas.PRICE)


def held(spark, root):
    return sorted((r.date, r.stock_id, r.close) for r in readers.partitioned(spark, root, schemas.PRICE).collect())


def test_days_are_replaced_whole_and_others_stay(spark, tmp_path):
    root = str(tmp_path / "bars")
    sinks.write_partitioned(bars(spark, (D(2024, 8, 1), "1", 1.0), (D(2024, 8, 2), "1", 1.0), (D(2024, 9, 2), "1", 1.0)), root)
    assert sorted(x for x in os.listdir(f"{root}/year=2024") if "=" in x) == ["month=8", "month=9"]
    day = bars(spark, (D(2024, 8, 2), "2", 5.0))
    for _ in range(2):
        versions.replace_days(day, root, schemas.PRICE)
        assert held(spark, root) == [(D(2024, 8, 1), "1", 1.0), (D(2024, 8, 2), "2", 5.0), (D(2024, 9, 2), "1", 1.0)]
    assert readers.partitioned(spark, root, schemas.PRICE).where("year = 2024 AND month = 8").count() == 2
    assert readers.partitioned(spark, str(tmp_path / "none"), schemas.PRICE).columns[-2:] == ["year", "month"]
    assert sinks.storage(spark, root)[0] >= 2
    assert {r.status for r in storage_checks(readers.open_warehouse(spark, str(tmp_path)), root).collect()} == {"PASS"}


def test_run_log_and_results(spark, tmp_path, monkeypatch):
    logs = str(tmp_path / "logs")
    with sinks.RunRecord(spark, logs, "daily") as run:
        run.metrics["rows"] = 3
    with pytest.raises(ZeroDivisionError), sinks.RunRecord(spark, logs, "daily"):
        1 / 0  # noqa: B018
    from quotewell.operators.feed_views import runs_of

    got = {r.status: r for r in runs_of(readers.run_log(spark, f"{logs}/*.jsonl")).collect()}
    assert set(got) == {"success", "failed"} and got["failed"].error_count == 1 and json.loads(got["success"].metrics) == {"rows": 3} and got["success"].started_at is not None
    assert readers.run_log(spark, f"{tmp_path}/none/*.jsonl").isEmpty()
    path = str(tmp_path / "r.csv")
    assert sinks.save_csv(spark.range(3), path) == 3 and open(path, "rb").read(3) == b"\xef\xbb\xbf"
    assert readers.csv_results(spark, path).columns == ["id"]
    sinks.save_parquet(spark.range(3), str(tmp_path / "r"))
    assert sinks.row_count(spark, str(tmp_path / "r")) == 3
    monkeypatch.setattr(sinks, "SHEET_ROWS", 3)
    with pytest.raises(ValueError, match="write Parquet"):
        sinks.save_csv(spark.range(3), path)


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "snaps")
    spark.createDataFrame([("1", "2020-01-01")], "stock_id string, date string").coalesce(1).write.parquet(root)
    spark.createDataFrame([("2", "a", "2021-01-01")], "stock_id string, industry string, date string").coalesce(1).write.mode("append").parquet(root)
    got = sorted(tuple(r) for r in readers.snapshots(spark, root, schemas.RAW_INDUSTRY).select("stock_id", F.coalesce("industry", F.lit("-"))).collect())
    assert got == [("1", "-"), ("2", "a")] and readers.latest_snapshot(spark, root, schemas.RAW_INDUSTRY).count() == 1


def test_warehouse_opens_before_anything_is_there(spark, tmp_path):
    w = readers.open_warehouse(spark, str(tmp_path / "new"))
    assert w.feed_v_daily_coverage.count() == 0 and w.feed_v_missing_trading_days.count() == 0 and w.vendor_v_security_gaps.count() == 0
    assert set(v for v in w.smoke_test().values() if isinstance(v, int)) <= {0, 1}
