"""The registered queries at the smallest size: those with SQL against it, all against their contracts' columns."""

import duckdb
import pytest

from quotewell.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "op1_url_filter": {"page_id", "host", "path", "rule", "verdict"},
    "op2_quality": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op3_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op4_mixing": {"doc_id", "copies"},
    "op5_substring_dedup": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op6_line_dedup": {"doc_id", "n_removed", "kept_sha256"},
    "op7_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op8_licenses": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op9_simhash": {"doc_id", "fingerprint", "component_id"},
    "op10_secrets": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op11_neighbours": {"query_id", "rank", "vec_id", "score"},
    "op12_periodic_runs": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
    "op13_token_align": {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
}


def test_every_query_has_its_columns():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, sf_dir, name):
    out = QUERIES[name](spark, sf_dir)
    assert COLUMNS[name] <= set(out.columns)
    rows = out.collect()
    if name.startswith("op11_"):  # five of each query's neighbours
        wanted = 5 * spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("vec_id % 50 = 0").count()
    else:
        wanted = spark.read.parquet(f"{sf_dir}/{'pages' if name.startswith('op1_') else 'documents'}.parquet").count()
    assert len(rows) == wanted
    if name in ORACLES:
        db = duckdb.connect()
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
        told = db.execute(ORACLES[name])
        names = [x[0] for x in told.description]
        assert sorted(names) == sorted(out.columns)
        assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(told.fetchall())
