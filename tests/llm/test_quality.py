import re
from collections import Counter

import numpy as np
import pytest

from quotewell.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \n\t", "a b c", "a b c a b c", "x x x x x", "é # $$ |a<b>\n# $$\né # $$ |a<b>\n\n\n", "w\x0bv\x0cu\x1ct\x85s", "long " * 30_000, "one two three four one two three"]


@pytest.mark.parametrize("text", TEXTS)
def test_measures(text):
    got = q.measure((text or "").encode(), q.Words(), np.zeros(q.BUCKETS))
    assert got[:5] == measures(text)


def clean(k):
    return " ".join(f"good{(k * 7 + j * j) % 50}" for j in range(60))


def junk(k):
    return " ".join(f"bad{(k * 5 + j * j) % 50}!!" for j in range(60))


def corpus():
    rows = [(k, clean(k) if k % 3 else junk(k)) for k in range(120)] + [(500, None), (501, ""), (502, "short text"), (503, clean(1)), (503, clean(1)), (None, clean(2)), (504, "again and again " * 40)]
    return rows


def labelled(spark):
    rows = [(k, 1 if k % 3 else 0, 0) for k in range(60)] + [(61, None, None), (None, 1, 0), (9_999, 1, 0), (1, 1, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_scores_against_brute_force(spark, documents):
    rows = corpus()
    out = q.quality_scores(documents(rows), labelled(spark))
    ratio, good, bad = q.ngram_model(documents(rows), labelled(spark))
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    words, want = q.Words(), []
    scores = {i: q.measure((t or "").encode(), q.Words(), ratio)[5] for i, t in rows}
    cut = q.threshold(np.array([scores[i] for i in good if i in scores]), np.array([scores[i] for i in bad if i in scores]))
    for i, t in rows:
        m = measures(t)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        s = q.measure((t or "").encode(), words, ratio)[5]
        want.append((i, *m, s, failed, cut, not failed and s >= cut))
    assert got == sorted(want, key=repr)
    by_id = {r[0]: r for r in got}
    assert all(by_id[k][-1] == bool(k % 3) for k in range(120)) and not by_id[504][-1] and not by_id[502][-1]


def test_model_counts_every_document(spark, documents, monkeypatch):
    rows = [(1, "a b"), (2, "a a"), (3, None)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(1, 3)], "doc_id bigint, quality int, toxic int")
    ratio, _, _ = q.ngram_model(documents(rows), labels)
    words = q.Words()
    seen = np.zeros(q.BUCKETS)
    for _, t in rows:
        np.add.at(seen, words.buckets(words.numbers((t or "").encode().split())), 1)
    p = (seen + 0.5) / (seen + 0.5).sum()
    assert np.isfinite(ratio).all() and abs((p * np.exp(ratio)).sum() - 1) < 1e-9


def test_rows_kept_are_whole(spark, documents):
    docs = documents(corpus())
    out = q.good_rows(docs, labelled(spark))
    want = {r.doc_id for r in q.quality_scores(docs, labelled(spark)).where("kept").collect()}
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == want


def test_without_labels_and_empty(spark, documents):
    none = labelled(spark).limit(0)
    kept = {r.doc_id for r in q.quality_scores(documents(corpus()), none).where("kept").collect()}
    assert kept >= set(range(120)) and 502 not in kept
    assert q.quality_scores(documents([]), none).count() == 0 and q.good_rows(documents([]), labelled(spark)).count() == 0


def test_threshold_spares_good_rows():
    assert q.threshold(np.array([1.0, 2.0]), np.array([-3.0, -2.0])) == -0.5
    assert q.threshold(np.array([0.0, 5.0]), np.array([1.0] * 5)) < 0.0
    assert q.threshold(np.array([]), np.array([1.0])) == q.NO_THRESHOLD


def test_forgetting_words_changes_nothing(monkeypatch):
    ratio = np.linspace(-1, 1, q.BUCKETS)
    texts = [clean(k).encode() for k in range(20)]
    want = [q.measure(t, q.Words(), ratio) for t in texts]
    monkeypatch.setattr(q, "REMEMBERED", 3)
    words = q.Words()
    assert [q.measure(t, words, ratio) for t in texts] == want
    assert q.repeated_words(np.array([1 << 21, 2, 3, 1 << 21, 2, 3])) == 6
