"""DuckDB SQL of the upkeep queries, from their definitions."""

from __future__ import annotations

from quotewell.operators.upkeep import AS_OF, CLOSED, HELD_UNTIL

_STAMP = f"CAST(DATE '{AS_OF}' AS TIMESTAMP)"


def _typed(source: str) -> str:
    return f"""SELECT try_cast(date AS DATE) AS date, stock_id, close AS open, close * 2 AS high, close / 2 AS low, close, CAST(0 AS DOUBLE) AS spread,
        n * 10 AS volume, n AS turnover_value, n AS transactions, '{source}' AS source FROM feed_raw_{source} WHERE try_cast(date AS DATE) IS NOT NULL"""


def _processed(prefer: str, other: str) -> str:
    once = "QUALIFY row_number() OVER (PARTITION BY stock_id, date ORDER BY volume DESC, close DESC) = 1"
    return f"""
        SELECT p.*, {_STAMP} AS ingested_at, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
        FROM (WITH good AS ({_typed(prefer)} {once}), spare AS ({_typed(other)} {once})
              SELECT * FROM good UNION ALL SELECT * FROM spare ANTI JOIN good USING (stock_id, date)) p"""


_SHAPE = """CASE WHEN starts_with(stock_id, '00') AND length(stock_id) BETWEEN 4 AND 6 THEN 'etf' WHEN stock_id[1] <> '0' AND length(stock_id) = 4 THEN 'common'
    WHEN length(stock_id) IN (5, 6) OR (stock_id[1] = '0' AND length(stock_id) = 4) THEN 'warrant' ELSE 'other' END"""  # ids here are digits
_LOG = """SELECT stock_id, stock_name, unnest(list_distinct([coalesce(CAST(delisted_date AS VARCHAR), ''), CAST(last_seen AS VARCHAR)])) AS day FROM feed_delisted WHERE source IN ('both', 'delisting')"""
_DAYS = f"SELECT DISTINCT stock_id, stock_name, try_cast(day AS DATE) AS delisted_date FROM ({_LOG}) g"
_LATEST = f"SELECT stock_id, max(stock_name) AS stock_name, max(delisted_date) AS delisted_date FROM ({_DAYS}) e GROUP BY stock_id"
_MIDDLE = "SELECT list(date ORDER BY date)[count(*) // 2 + 1] AS date FROM feed_calendar GROUP BY year(date), month(date)"
_BOOKS = f"SELECT stock_id, max(date) AS last_date FROM vendor_bars WHERE date <= DATE '{HELD_UNTIL}' GROUP BY stock_id"
_HELD = f"SELECT DISTINCT date FROM feed_bars WHERE date <= DATE '{HELD_UNTIL}'"


def _seen(days: str) -> str:
    return f"""SELECT stock_id, {_SHAPE} AS shape, min(date) AS first_seen, max(date) AS last_seen, count(DISTINCT date) AS sample_hits, max(sampled) AS sampled_days, {_STAMP} AS discovered_at
        FROM (SELECT b.stock_id, b.date, (SELECT count(DISTINCT date) FROM feed_bars WHERE date IN ({_MIDDLE}) AND {days}) AS sampled FROM feed_bars b WHERE date IN ({_MIDDLE}) AND {days}) s GROUP BY stock_id"""


_CHECKABLE = """SELECT DISTINCT stock_id FROM feed_v_securities_all a
    WHERE NOT EXISTS (SELECT 1 FROM feed_delisted d WHERE d.stock_id = a.stock_id AND d.delisted_date IS NOT NULL AND d.delisted_date >= coalesce((SELECT max(date) FROM feed_bars b WHERE b.stock_id = a.stock_id), DATE '0001-01-01'))"""

UPKEEP: dict[str, str] = {
    "etl_typed_prices": _typed("market"),
    "etl_prices_prefer_market": _processed("market", "ticker"),
    "etl_prices_prefer_ticker": _processed("ticker", "market"),
    "etl_stock_info": """
        SELECT min(snapshot_date) AS snapshot_date, stock_id, stock_name, industry_category, CASE industry_category WHEN 'CHINA' THEN 'FAR EAST' WHEN 'Index' THEN 'INDICES' ELSE industry_category END AS industry_category_norm, type,
               industry_category = 'Index' AS is_index
        FROM feed_stock_info GROUP BY stock_id, stock_name, industry_category, type""",
    "etl_industry": "SELECT stock_id, industry, sub_industry, snapshot_date FROM feed_industry",
    "etl_delisting_log": _DAYS,
    "etl_latest_delisting": _LATEST,
    "etl_delisted_securities": f"""
        SELECT stock_id, e.stock_name, e.delisted_date, coalesce(d.shape, {_SHAPE}) AS shape, d.first_seen, d.last_seen,
               CASE WHEN e.stock_id IS NULL THEN 'discovered' WHEN d.stock_id IS NULL THEN 'delisting' ELSE 'both' END AS source
        FROM (SELECT * FROM feed_delisted WHERE source IN ('both', 'discovered')) d FULL JOIN ({_LATEST}) e USING (stock_id)
        WHERE {_SHAPE} IN ('common', 'etf') AND stock_id NOT IN (SELECT stock_id FROM feed_stock_info WHERE snapshot_date = DATE '2001-01-04')""",
    "etl_expanded_calendar": """
        SELECT date, CASE WHEN date IN (SELECT date FROM feed_calendar_raw) THEN 'official' ELSE 'derived' END AS source
        FROM (SELECT date FROM feed_calendar_raw UNION SELECT date FROM feed_bars UNION SELECT date FROM feed_adj_bars) d""",
    "etl_record_empty": f"""
        SELECT date, {_STAMP} AS confirmed_at FROM (SELECT date FROM feed_known_empty WHERE date IS NOT NULL
        UNION SELECT date FROM feed_calendar_raw WHERE day(date) = 14 AND date < (SELECT max(date) FROM ({_HELD}) h)) d""",
    "etl_observations": _seen("true"),
    "etl_merged_observations": f"""
        SELECT stock_id, max(shape) AS shape, min(first_seen) AS first_seen, max(last_seen) AS last_seen, CAST(sum(sample_hits) AS BIGINT) AS sample_hits, CAST(sum(sampled_days) AS BIGINT) AS sampled_days, max(discovered_at) AS discovered_at
        FROM (({_seen(f"date <= DATE '{HELD_UNTIL}'")}) UNION ALL ({_seen(f"date > DATE '{HELD_UNTIL}'")})) o GROUP BY stock_id""",
    "plan_trading_days": f"SELECT date FROM feed_calendar WHERE date >= DATE '{HELD_UNTIL}' AND date <= DATE '{CLOSED}'",
    "plan_last_closed_day": f"SELECT date FROM feed_calendar WHERE date <= DATE '{CLOSED}' ORDER BY date DESC LIMIT 1",
    "plan_missing_dates": f"SELECT date FROM feed_calendar WHERE date BETWEEN DATE '1997-01-01' AND DATE '{CLOSED}' EXCEPT ({_HELD})",
    "plan_shifted_day": f"SELECT min(date) AS date FROM (SELECT date FROM feed_calendar WHERE date <= DATE '{CLOSED}' ORDER BY date DESC LIMIT 6) t",
    "plan_middle_days": _MIDDLE,
    "plan_daily_targets": f"""
        SELECT date, CASE WHEN date > (SELECT max(date) FROM ({_HELD}) h) THEN 'forward' ELSE 'gap' END AS reason FROM (
            SELECT date FROM feed_calendar WHERE date > (SELECT min(date) FROM ({_HELD}) h) AND date <= DATE '{CLOSED}' EXCEPT ({_HELD}) EXCEPT SELECT date FROM feed_known_empty) d
        UNION ALL SELECT date, 'revision' FROM (SELECT date FROM ({_HELD}) h ORDER BY date DESC LIMIT 3) r""",
    "plan_checkable": _CHECKABLE,
    "plan_reconcile": f"""
        SELECT 'missing day' AS kind, CAST(date AS VARCHAR) AS key FROM feed_v_missing_trading_days
        UNION ALL SELECT 'thin day', CAST(date AS VARCHAR) FROM feed_v_thin_trading_days
        UNION ALL SELECT 'absent security', stock_id FROM ({_CHECKABLE}) k WHERE stock_id NOT IN (SELECT stock_id FROM feed_bars)
        UNION ALL SELECT 'stale security', stock_id FROM ({_CHECKABLE}) k JOIN feed_bars USING (stock_id) GROUP BY stock_id HAVING max(date) < DATE '{CLOSED}' - 30""",
    "plan_workbooks": f"""
        SELECT s.stock_id, d.date FROM ({_BOOKS}) s JOIN feed_calendar d ON d.date > s.last_date AND d.date <= DATE '{CLOSED}'
        WHERE s.last_date IN (SELECT date FROM feed_calendar)
          AND (SELECT count(*) FROM feed_calendar x WHERE x.date > s.last_date AND x.date <= (SELECT last_date FROM ({_BOOKS}) m GROUP BY last_date ORDER BY count(*) DESC, last_date DESC LIMIT 1)) <= 20""",
    "plan_index_seed": f"""
        SELECT date, date <= DATE '{CLOSED}' AS required FROM feed_calendar
        WHERE year(date) = {HELD_UNTIL.year} AND date > DATE '{HELD_UNTIL}' AND date <= (SELECT min(date) FROM feed_calendar WHERE date > DATE '{CLOSED}')""",
    "plan_members_without_prices": "SELECT stock_id, stock_name, first_date, last_date FROM vendor_v_index_universe WHERE has_price_history = false",
    "plan_company_pool": "SELECT stock_id, first_seen AS listed_date, delisted_date FROM feed_delisted WHERE shape = 'common' AND first_seen IS NOT NULL AND coalesce(delisted_date, DATE '9999-01-01') >= DATE '1996-01-01'",
    "rules_ids": f"SELECT stock_id, {_SHAPE} AS shape, {_SHAPE} IN ('common', 'etf') AS in_scope, stock_id AS split_id, trim(stock_name) AS split_name FROM feed_delisted",
    "rules_texts": "SELECT DISTINCT date AS raw, nullif(date, 'None') AS text, try_cast(date AS DATE) AS day FROM feed_raw_market",
    "rules_numbers": """
        SELECT quantity, quantity + quantity % 2 AS rounded, DATE '1899-12-30' + CAST(quantity + 36773 AS INTEGER) AS day FROM (SELECT DISTINCT CAST(l_quantity AS BIGINT) AS quantity FROM lineitem) q""",
}
