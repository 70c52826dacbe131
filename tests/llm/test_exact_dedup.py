import hashlib

import pytest
from pyspark.sql import functions as F

from quotewell.llm import exact_dedup as e

ROWS = [(1, "a"), (5, "a"), (3, "b"), (4, None), (6, ""), (7, "é\n" * 9000), (8, "é\n" * 9000), (9, "A"), (9, "A"), (None, "b"), (None, "z")]


def expected(rows, keep=max):
    """Brute force; of rows equal in id and text one stays."""
    out, seen = [], set()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    for i, t in rows:
        ids = groups[t or ""]
        best = keep([x for x in ids if x is not None], default=None)
        first = (i, t or "") not in seen
        seen.add((i, t or ""))
        out.append((i, best, len(ids), i == best and first, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_against_brute_force(documents):
    assert rows_of(e.exact_dedup(documents(ROWS))) == expected(ROWS)
    assert rows_of(e.exact_dedup(documents(ROWS), keep="smallest")) == expected(ROWS, min)
    with pytest.raises(ValueError, match="keep"):
        e.exact_dedup(documents(ROWS), keep="any")


def test_hot_text_is_dealt_out_and_joined(documents, monkeypatch):
    rows = [(k, "hot" if k % 3 else f"t{k}") for k in range(600)] + [(None, "hot"), (599, "hot")] + [(k, "warm") for k in range(700, 800)]
    assert len(e.hot_texts(documents(rows).select(F.col("doc_id").alias("id"), F.col("text").alias("t")))) == 2
    assert rows_of(e.exact_dedup(documents(rows))) == expected(rows)


def test_whole_rows(documents):
    out = e.distinct_texts(documents(ROWS))
    assert out.columns == documents(ROWS).columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted(((i, t) for i, t in [(5, "a"), (3, "b"), (6, ""), (8, "é\n" * 9000), (9, "A"), (None, "z")]), key=repr)


def test_normalised_and_empty(documents):
    out = e.exact_dedup(documents([(1, "A "), (2, "a")]), normalise=lambda c: F.lower(F.trim(c)))
    assert {r.doc_id: r.keep_id for r in out.collect()} == {1: 2, 2: 2}
    assert e.exact_dedup(documents([])).count() == 0 and e.distinct_texts(documents([])).count() == 0
