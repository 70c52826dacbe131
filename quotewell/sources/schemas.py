"""Contracts: the columns and types of every dataset, raw and processed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewell.operators.vendor_views import CONSTITUENT, VENDOR_BAR


_KINDS = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def schema(text: str) -> T.StructType:
    """'name kind, name kind': needs no session, unlike Spark's own parser."""
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in (x.split() for x in text.split(", "))])


RAW_PRICE = schema("date string, stock_id string, Trading_Volume bigint, Trading_money bigint, open double, max double, min double, close double, spread double, Trading_turnover bigint")
PRICE = schema("date date, stock_id string, open double, high double, low double, close double, spread double, volume bigint, turnover_value bigint, transactions bigint, source string, ingested_at timestamp")
RAW_STOCK_INFO = schema("industry_category string, stock_id string, stock_name string, type string, date string")
STOCK_INFO = schema("snapshot_date date, stock_id string, stock_name string, industry_category string, industry_category_norm string, type string, is_index boolean")
RAW_INDUSTRY = schema("stock_id string, industry string, sub_industry string, date string")
INDUSTRY = schema("stock_id string, industry string, sub_industry string, snapshot_date date")
RAW_DELISTING = schema("date string, stock_id string, stock_name string")
DELISTING = schema("stock_id string, stock_name string, delisted_date date")
DISCOVERED = schema("stock_id string, shape string, first_seen date, last_seen date, sample_hits bigint, sampled_days bigint, discovered_at timestamp")
DELISTED = schema("stock_id string, stock_name string, delisted_date date, shape string, first_seen date, last_seen date, source string")
CALENDAR = schema("date date, source string")
KNOWN_EMPTY = schema("date date, confirmed_at timestamp")
RUN = schema("job string, status string, started_at string, finished_at string, duration_seconds double, host string, pid bigint, metrics string, events string, errors array<string>")

_TEXT = {"limit_flag", "attention_flag", "disposition_flag", "full_delivery_flag", "market", "stock_id", "stock_name", "source_file", "index_id", "index_name"}


def _typed(names: tuple[str, ...]) -> T.StructType:
    kinds = {"date": "date", "ingested_at": "timestamp", "transactions": "bigint", "year": "int", "month": "int"}
    return schema(", ".join(f"{n} {kinds.get(n) or ('string' if n in _TEXT else 'double')}" for n in names))


_SCAN = "file_bytes bigint, modified_at timestamp, sheet_name string, defined_name string, defined_range string, declared_rows bigint, vendor_table string, vendor_field_count bigint, descending boolean, query_matches_contract boolean, scanned_at timestamp"
WORKBOOK_SCAN, INDEX_WORKBOOK_SCAN = schema(f"source_file string, stock_id string, {_SCAN}"), schema(f"source_file string, index_id string, year int, {_SCAN}")
VENDOR_PRICE = _typed(VENDOR_BAR)
INDEX_ROW = _typed(CONSTITUENT)


class ContractError(ValueError):
    """A dataset lacks columns of its contract."""


def enforce(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns in its order and types. A missing column is an error."""
    missing = [f.name for f in contract if f.name not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in contract))


def coerce(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Raw rows: columns that are absent are null, and values that don't fit become null."""
    return df.select(*((F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in contract))
