import os

import pytest
from pyspark.sql import functions as F

from quotewell.llm import common


def test_tables_in_the_shared_folder(spark):
    t = common.materialise(spark.range(3), "t")
    folder = os.path.dirname(t.inputFiles()[0].removeprefix("file://"))
    assert t.count() == 3 and folder.startswith(common.shared_dir(spark).removeprefix("file://"))
    common.discard(t)
    assert not os.path.exists(folder)
    t = common.materialise(spark.range(3), "t")
    folder = os.path.dirname(t.inputFiles()[0].removeprefix("file://"))
    assert common.drop_tables(spark) >= 1 and not os.path.exists(folder) and common.drop_tables(spark) == 0


@pytest.mark.parametrize(("a", "b", "same"), [((1, "x"), (1, "x"), True), ((1, "x"), (2, "x"), False), ((None, "x"), (None, "x"), True), ((None, "1 x"), (1, "x"), False), ((1, ""), (None, ""), False)])
def test_row_keys(spark, a, b, same):
    rows = spark.createDataFrame([a, b], "i long, t string").select(common.row_key(F.col("i"), F.col("t")).alias("k")).collect()
    assert (rows[0].k == rows[1].k) == same and len(rows[0].k) == 16
