"""The warehouse's base tables made from generic order tables, for trials without market data.

A supplier plays a security and a ship day a session: see BASE. The texts use what Spark SQL and DuckDB share, so that the
same rows exist in both; {name} stands for an input table. Sums are over decimals, so no result depends on the order of rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from quotewell.plans.warehouse import Warehouse

#: In order: a table may read the ones before it.
BASE: dict[str, str] = {
    # what one supplier shipped in a day
    "shipped": """
        SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS date,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS paid,
               CAST(sum(CAST(l_quantity AS DECIMAL(18,0))) AS DOUBLE) AS units,
               CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS off,
               CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS tax,
               max(l_extendedprice / l_quantity) AS top, min(l_extendedprice / l_quantity) AS bottom,
               count(*) AS n, max(l_shipdate) AS stamp
        FROM {lineitem} GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "quoted": """
        SELECT *, lpad(CAST(k AS STRING), 4, '0') AS stock_id, paid / units AS px, off / n AS cut,
               CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, datediff(date, DATE '1995-01-01') AS day_no
        FROM shipped""",
    # unadjusted bars: a day without tax is one without trade, coded 0
    "feed_bars": """
        SELECT date, stock_id, bottom AS open, top AS high, bottom AS low, CASE WHEN tax = 0 THEN CAST(0 AS DOUBLE) ELSE px END AS close, top - bottom AS spread,
               CAST(units * 1000 AS BIGINT) AS volume, CAST(floor(paid) AS BIGINT) AS turnover_value, n AS transactions,
               CASE WHEN k % 7 = 0 THEN 'market' ELSE 'ticker' END AS source, stamp AS ingested_at, year, month
        FROM quoted WHERE (k + day_no) % 13 <> 0 AND day_no % 101 <> 0""",
    # adjusted bars: the discount plays the adjustment
    "feed_adj_bars": """
        SELECT date, stock_id, bottom * (1 - cut) AS open, top * (1 - cut) AS high, bottom * (1 - cut) AS low, px * (1 - cut) AS close, top - bottom AS spread,
               CAST(units * 1000 AS BIGINT) AS volume, CAST(floor(paid) AS BIGINT) AS turnover_value, n AS transactions,
               CASE WHEN (k + day_no) % 9 = 0 THEN 'market' ELSE 'ticker' END AS source, stamp AS ingested_at, year, month
        FROM quoted WHERE (k + day_no) % 11 <> 0""",
    # raw adjusted snapshots: whole histories by ticker, and days of the whole market on an older basis
    "feed_raw_ticker": """
        SELECT CAST(date AS STRING) AS date, stock_id, px * (1 - CASE WHEN k % 4 = 0 THEN cut / 2 ELSE cut END) AS close, n FROM quoted WHERE k % 7 <> 0""",
    "feed_raw_market": """
        SELECT CASE WHEN k % 50 = 49 THEN 'None' ELSE CAST(date AS STRING) END AS date, stock_id, px * (1 - cut / 4) AS close, n FROM quoted""",
    "feed_calendar_raw": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM {orders}",
    "feed_calendar": """
        SELECT date, CASE WHEN max(o) = 1 THEN 'official' ELSE 'derived' END AS source
        FROM (SELECT date, 1 AS o FROM feed_calendar_raw UNION ALL SELECT date, 0 AS o FROM feed_bars) GROUP BY date""",
    "feed_stock_info": """
        SELECT CASE WHEN (s_suppkey + i) % 17 = 0 THEN CAST(NULL AS DATE) WHEN i = 0 THEN DATE '1999-01-04' WHEN i = 1 THEN DATE '2000-01-04' ELSE DATE '2001-01-04' END AS snapshot_date,
               lpad(CAST(s_suppkey AS STRING), 4, '0') AS stock_id, s_name AS stock_name,
               CASE WHEN s_suppkey % 25 = 0 THEN 'Index' WHEN i = 2 AND s_suppkey % 3 = 0 THEN concat(n_name, ' B') ELSE n_name END AS industry_category,
               CASE WHEN s_suppkey % 25 = 0 THEN 'Index' ELSE n_name END AS industry_category_norm,
               CASE WHEN s_suppkey % 5 IN (0, 1) THEN 'main' WHEN s_suppkey % 5 = 2 THEN 'second' ELSE 'other' END AS type, s_suppkey % 25 = 0 AS is_index
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2) AS snaps""",
    "feed_delisted": """
        SELECT CASE WHEN c_custkey < 3000 THEN lpad(CAST(c_custkey * 3 AS STRING), 4, '0') ELSE CAST(c_custkey * 3 AS STRING) END AS stock_id, c_name AS stock_name,
               CASE WHEN c_custkey % 4 = 0 THEN CAST(NULL AS DATE) ELSE CAST(min(o_orderdate) AS DATE) END AS delisted_date,
               CASE WHEN c_custkey % 6 = 0 THEN 'etf' ELSE 'common' END AS shape, CAST(min(o_orderdate) AS DATE) AS first_seen, CAST(max(o_orderdate) AS DATE) AS last_seen,
               CASE WHEN c_custkey % 3 = 0 THEN 'both' WHEN c_custkey % 3 = 1 THEN 'discovered' ELSE 'delisting' END AS source
        FROM {customer} JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey, c_name""",
    "feed_industry": """
        SELECT lpad(CAST(l_suppkey AS STRING), 4, '0') AS stock_id, p_brand AS industry, CASE WHEN p_size % 5 = 0 THEN CAST(NULL AS STRING) ELSE p_type END AS sub_industry,
               CAST(max(l_shipdate) AS DATE) AS snapshot_date
        FROM {lineitem} JOIN {part} ON p_partkey = l_partkey
        GROUP BY l_suppkey, p_brand, CASE WHEN p_size % 5 = 0 THEN CAST(NULL AS STRING) ELSE p_type END""",
    "feed_known_empty": """
        SELECT date, CAST(date AS TIMESTAMP) AS confirmed_at FROM feed_calendar_raw WHERE day(date) = 13
        UNION ALL SELECT CAST(NULL AS DATE), CAST(NULL AS TIMESTAMP)""",
    "feed_runs": """
        SELECT event_type AS job, CASE WHEN event_id % 10 = 0 THEN 'failed' WHEN event_id % 15 = 0 THEN 'partial' ELSE 'ok' END AS status, CAST(ts AS STRING) AS started_at, CAST(ts AS STRING) AS finished_at,
               value AS duration_seconds, concat('host', CAST(user_id % 3 AS STRING)) AS host, props AS metrics, event_id
        FROM {events}""",
    "vendor_bars": """
        SELECT date, stock_id, concat('Security ', CAST(k AS STRING)) AS stock_name, bottom AS open, top AS high, bottom AS low,
               CASE WHEN k = 9 AND day_no % 40 = 0 THEN CAST(0 AS DOUBLE) WHEN (k + day_no) % 5 = 0 THEN px * (1 - cut) ELSE px END AS close,
               CASE WHEN day_no % 31 = 0 THEN CAST(0 AS DOUBLE) WHEN day_no % 37 = 0 THEN units / 1000 ELSE units END AS volume_k_shares,
               paid / 1000 AS turnover_k, CASE WHEN k % 10 = 3 THEN n + 1 ELSE n END AS transactions,
               CASE WHEN tax = 0 THEN CAST(NULL AS DOUBLE) ELSE tax / n * 100 END AS return_pct, tax / n AS return_ln, cut * 100 AS turnover_pct,
               units AS shares_outstanding_k, paid AS market_cap_m, cut AS market_cap_weight_pct, cut AS turnover_weight_pct,
               px / 10 AS pe_a, px / 11 AS pe_b, px / 20 AS pbr_a, px / 21 AS pbr_b, px / 30 AS psr_b, cut AS div_yield_a, cut AS cash_div_yield,
               top - bottom AS price_change, (top - bottom) / px AS high_low_spread_pct, bottom AS bid, top AS offer,
               px AS next_ref_price, px * 1.1E0 AS next_limit_up, px * 0.9E0 AS next_limit_down,
               CAST(NULL AS STRING) AS limit_flag, CAST(NULL AS STRING) AS attention_flag, CAST(NULL AS STRING) AS disposition_flag, CAST(NULL AS STRING) AS full_delivery_flag,
               CASE k % 5 WHEN 0 THEN 'TSE' WHEN 1 THEN 'OTC' WHEN 2 THEN 'TIB' WHEN 3 THEN 'REG' ELSE 'PSB' END AS market,
               concat(stock_id, '.xlsx') AS source_file, stamp AS ingested_at, year, month
        FROM quoted WHERE k % 10 <> 7 AND NOT (k % 10 = 6 AND day_no > 2000)""",
    "monthly": "SELECT k, year, month, CAST(sum(CAST(paid AS DECIMAL(18,2))) AS DOUBLE) AS paid FROM quoted GROUP BY k, year, month",
    "placed": "SELECT *, row_number() OVER (PARTITION BY year, month ORDER BY paid DESC, k) AS place FROM monthly",
    "members": """
        SELECT *, CASE WHEN place <= 5 THEN 'TWN50' ELSE 'TM100' END AS index_id,
               paid / CAST(sum(CAST(paid AS DECIMAL(18,2))) OVER (PARTITION BY year, month, place <= 5) AS DOUBLE) * 100 AS weight
        FROM placed WHERE place <= 15""",
    "index_rows": """
        SELECT d.date, m.index_id, CASE WHEN m.index_id = 'TWN50' THEN 'Largest' ELSE 'Mid-sized' END AS index_name, lpad(CAST(m.k AS STRING), 4, '0') AS stock_id,
               concat('Security ', CAST(m.k AS STRING)) AS stock_name, m.weight AS prev_weight_pct, CAST(1 AS DOUBLE) AS index_factor, CAST(0.5 AS DOUBLE) AS free_float_factor, CAST(1 AS DOUBLE) AS cap_factor,
               m.paid AS shares, CAST(100 AS DOUBLE) AS index_base_value, m.paid / 100 AS prev_adj_close, concat(m.index_id, '/', CAST(m.year AS STRING), '.xlsx') AS source_file,
               d.stamp AS ingested_at, m.year, m.month
        FROM members m JOIN (SELECT date, year, month, max(stamp) AS stamp FROM quoted GROUP BY date, year, month) d ON d.year = m.year AND d.month = m.month
        WHERE m.index_id = 'TWN50' OR (m.place + day(d.date)) % 9 <> 0 OR m.year < 1998""",
    "vendor_workbooks": """
        SELECT concat(stock_id, '.xlsx') AS source_file, stock_id, CAST(count(*) * 1234 AS BIGINT) AS file_bytes, max(ingested_at) AS modified_at, 'Sheet1' AS sheet_name, 'grid' AS defined_name,
               'A1' AS defined_range, CAST(count(*) + CASE WHEN stock_id LIKE '%5' THEN 1 ELSE 0 END AS BIGINT) AS declared_rows, 'prices' AS vendor_table, 35 AS vendor_field_count, true AS descending,
               stock_id NOT LIKE '%11' AS query_matches_contract, max(ingested_at) AS scanned_at
        FROM vendor_bars GROUP BY stock_id""",
    "vendor_index_workbooks": """
        SELECT concat(index_id, '/', CAST(year AS STRING), '.xlsx') AS source_file, index_id, year, CAST(count(*) * 567 AS BIGINT) AS file_bytes, max(ingested_at) AS modified_at, 'Sheet1' AS sheet_name,
               'grid' AS defined_name, 'A1' AS defined_range, CAST(count(*) + CASE WHEN year % 3 = 0 THEN 2 ELSE 0 END AS BIGINT) AS declared_rows, 'constituents' AS vendor_table, 10 AS vendor_field_count,
               false AS descending, true AS query_matches_contract, max(ingested_at) AS scanned_at
        FROM index_rows GROUP BY index_id, year""",
    "vendor_runs": """
        SELECT concat('v-', event_type) AS job, CASE WHEN event_id % 14 = 0 THEN 'failed' ELSE 'ok' END AS status, CAST(ts AS STRING) AS started_at, CAST(ts AS STRING) AS finished_at,
               value AS duration_seconds, 'vhost' AS host, props AS metrics, event_id
        FROM {events}""",
}
TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "part", "events")


def oracle_base() -> str:
    """BASE as the common table expressions of a DuckDB query, with DuckDB's name for datediff."""
    ctes = []
    for name, text in BASE.items():
        sql = text.format(**{t: t for t in TABLES}).replace("datediff(date, DATE '1995-01-01')", "(date - DATE '1995-01-01')")
        ctes.append(f"{name} AS ({sql})")
    return ",\n".join(ctes)


class _Tables(dict):
    """Base tables, planned when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __contains__(self, name: object) -> bool:
        return super().__contains__(name) or name in BASE or name in TABLES

    def __missing__(self, name: str) -> DataFrame:
        if name in TABLES:
            made = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        else:
            sql = _READ.sub(lambda m: f"{m[1]}{{{m[2]}}}" if m[2] in BASE else m[0], BASE[name])
            made = self.spark.sql(sql, **{t: self[t] for t in re.findall(r"{(\w+)}", sql)})
        self[name] = made
        return made

    def beside(self, *names: str) -> DataFrame:
        """Tables that are made from quoted row by row, beside one another: a struct and a flag `has_` each. One pass over quoted makes them all."""
        parts = {name: _MADE_OF_QUOTED.fullmatch(BASE[name]).groups() for name in names}
        told = ", ".join(f"struct({columns}) AS {name}, ({where or 'true'}) AS has_{name}" for name, (columns, where) in parts.items())
        return self.spark.sql(f"SELECT stock_id, date, {told} FROM {{quoted}}", quoted=self["quoted"])


_MADE_OF_QUOTED = re.compile(r"\s*SELECT (.*?)\s+FROM quoted(?: WHERE (.*))?", re.S)
_READ = re.compile(r"((?:FROM|JOIN)\s+)(\w+)")


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse over the order tables in sf_dir. Nothing runs yet; unused tables cost nothing."""
    return Warehouse(spark, _Tables(spark, sf_dir))
