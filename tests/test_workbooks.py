"""Large workbooks: read by path, in batches, whole or not at all."""

import json
import tracemalloc
import zipfile

import pytest
from test_sources import CONTRACT, HEAD, NOW, SHEET, book

from quotewell.sources import readers, workbooks

DAYS = 5_000


def large(path, n, spoilt=None):
    """A sheet of n rows below its header, each with a string of its own in the table of strings. spoilt: rows after which the sheet ends in mid-air."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        with z.open("xl/sharedStrings.xml", "w") as f:
            f.write(b"<sst>" + b"".join(b"<si><t>%s</t></si>" % x.encode() for x in (*HEAD, "1101 Name")))
            for k in range(n):
                f.write(b"<si><t>flag %d</t></si>" % k)
            f.write(b"</sst>")
        with z.open("xl/worksheets/sheet1.xml", "w") as f:
            f.write(b"<worksheet><sheetData><row>%s</row>" % b"".join(b'<c t="s"><v>%d</v></c>' % k for k in range(len(HEAD))))
            for k in range(n if spoilt is None else spoilt):
                f.write(b'<row><c t="s"><v>5</v></c><c><v>%d</v></c><c><v>%d.5</v></c><c><v>%d</v></c><c t="s"><v>%d</v></c></row>' % (20_000 + k % DAYS, k, k, 6 + k))
            if spoilt is None:
                f.write(b"</sheetData></worksheet>")
    return path


def test_batches_are_bounded_and_complete(tmp_path):
    path = large(tmp_path / "a.xlsx", 10_000)
    sizes, rows = [], []
    with open(path, "rb") as f:
        for part in readers.checked_rows(f, CONTRACT.headers, 3_000):
            sizes.append(len(part))
            rows += part
    assert sizes == [3_000, 3_000, 3_000, 1_000]
    assert rows == [["1101 Name", str(20_000 + k % DAYS), f"{k}.5", str(k), f"flag {k}"] for k in range(10_000)]


@pytest.mark.parametrize(("n", "sizes"), [(0, []), (1, [1]), (4, [4]), (5, [4, 1]), (8, [4, 4])])
def test_batches_at_their_bound(tmp_path, n, sizes):
    assert [len(x) for x in readers.checked_rows(large(tmp_path / "a.xlsx", n).read_bytes(), CONTRACT.headers, 4)] == sizes


def peak(path):
    tracemalloc.start()
    with open(path, "rb") as f:
        n = sum(batch.num_rows for batch in readers.cell_batches(str(path), f, CONTRACT.headers))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return n, most


def test_memory_does_not_grow_with_the_sheet(tmp_path):
    n, few = peak(large(tmp_path / "a.xlsx", 10_000))
    m, many = peak(large(tmp_path / "b.xlsx", 50_000))
    assert (n, m) == (10_000, 50_000)
    assert many - few < 40_000 * 40  # what is left is the table of strings: text and an offset


def test_a_torn_sheet_gives_its_error_only(spark, tmp_path):
    large(tmp_path / "w/torn.xlsx", 9_000, spoilt=6_000)
    book(tmp_path / "w/good.xlsx", [HEAD, ["2330 Some Name", 36773, 133.5, 3324, None]])
    book(tmp_path / "w/odd.xlsx", [["Security", "Date", "Close", "Trades", "Flag"]])
    book(tmp_path / "w/stray.xlsx", [HEAD], {"xl/worksheets/sheet1.xml": SHEET % '<x:row><x:c t="s"><x:v>99</x:v></x:c></x:row>'})
    (tmp_path / "w/empty.xlsx").write_bytes(b"")
    (tmp_path / "w/~$good.xlsx").write_bytes(b"lock")
    cells = workbooks.large_workbook_cells(spark, str(tmp_path / "w"), CONTRACT)
    got = [(r.path.rpartition("/")[2], r.error and r.error.partition(":")[0], r.cells and r.cells[:2]) for r in cells.collect()]
    assert sorted(got, key=str) == [("empty.xlsx", "ArrowInvalid", None), ("good.xlsx", None, ["2330 Some Name", "36773"]), ("odd.xlsx", "ValueError", None), ("stray.xlsx", "ValueError", None), ("torn.xlsx", "ParseError", None)]
    rows = readers.price_workbooks(cells, CONTRACT, NOW)
    assert {r.source_file for r in readers.workbook_faults(cells, rows, "stock_id").collect()} == {"empty.xlsx", "odd.xlsx", "stray.xlsx", "torn.xlsx"}


def test_both_readers_agree(spark, tmp_path):
    for k in range(3):
        large(tmp_path / f"w/{k}/{k}.xlsx", 3_000 * k)
    one = readers.price_workbooks(readers.workbook_cells(spark, str(tmp_path / "w"), CONTRACT), CONTRACT, NOW)
    two = readers.price_workbooks(workbooks.large_workbook_cells(spark, f"file://{tmp_path}/w", CONTRACT), CONTRACT, NOW)
    assert one.count() == two.count() == 9_000
    assert one.exceptAll(two).isEmpty()


def test_partitions(spark, tmp_path):
    assert workbooks.dealt([("a", 3), ("b", 4), ("c", 9), ("d", 1)], 8) == [["a", "b"], ["c"], ["d"]]
    assert workbooks.large_workbook_cells(spark, str(tmp_path / "none"), CONTRACT).isEmpty()
    for k in range(3):
        book(tmp_path / f"w/{k}.xlsx", [HEAD, ["1 a", 36773 + k, 1, 1, None]])
    read = spark.read.format("workbook_rows").option("headers", json.dumps(HEAD))
    assert read.option("bytes", 1).load(str(tmp_path / "w")).rdd.getNumPartitions() == 3
    assert [r.cells[1] for r in read.load(str(tmp_path / "w/2.xlsx")).collect()] == ["36775"]


def test_sql(spark, tmp_path):
    large(tmp_path / "w/a.xlsx", 7_000)
    workbooks.register(spark)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW sheet USING workbook_rows OPTIONS (path '{tmp_path}/w', headers '{json.dumps(HEAD)}')")
    assert spark.sql("SELECT count(*) AS n, max(CAST(cells[3] AS INT)) AS most FROM sheet WHERE error IS NULL").first()[:] == (7_000, 6_999)
