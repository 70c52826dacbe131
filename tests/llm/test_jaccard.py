"""Near copies by similarity, against brute force over all pairs."""

import random

import numpy as np

import corpus_pipeline as cp
from quotewell.llm import jaccard, simhash


def similarity(a, b):
    x, y = ({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def changed(rnd, words, n):
    out = list(words)
    for k in rnd.sample(range(len(out)), n):
        out[k] = f"new{rnd.getrandbits(40)}"
    return out


def pairs_of(rnd, groups):
    """Texts of 150 to 400 words, and for each a copy with single words replaced."""
    rows = []
    for g in range(groups):
        words = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(150, 400))]
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(changed(rnd, words, max(1, len(words) * rnd.randint(14, 26) // 1000))))]
    return rows


def test_near_stage_finds_every_pair_of_the_range(spark, documents):
    rows = pairs_of(random.Random(5), 60)
    texts = dict(rows)
    similar = {g for g in range(60) if similarity(texts[2 * g], texts[2 * g + 1]) >= cp.NEAR_LEAST}
    prints = {i: simhash.fingerprint_pair(t.encode(), cp.NEAR_SHINGLE, True) for i, t in rows}
    apart = lambda g, k: (prints[2 * g][k] ^ prints[2 * g + 1][k]).bit_count()
    near = {g for g in range(60) if apart(g, 0) <= cp.NEAR_BITS and apart(g, 1) <= cp.NEAR_SECOND_BITS}
    assert len(similar - near) > 5 and len(similar) < 60  # fingerprints alone lose some, and not all are in the range
    kept = {r.doc_id for r in cp.near_copies(spark, documents(rows), "").collect()}
    assert kept == set(texts) - {2 * g + 1 for g in similar | near}


def test_all_links_of_a_chain_and_no_others(spark, documents):
    rnd = random.Random(2)
    words, rows = [f"w{rnd.randrange(5000)}" for _ in range(200)], []
    for i in range(25):  # each is similar to its neighbours, not to the first
        rows.append((i, " ".join(words)))
        words = changed(rnd, words, 4)
    rows += [(100 + k, " ".join(f"v{rnd.randrange(5000)}" for _ in range(80))) for k in range(5)] + [(200, None), (201, ""), (202, "a b"), (203, "A  b")]
    root = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for k, (_, b) in enumerate(rows[:i]):
            if similarity(a or "", b or "") >= 0.8:
                root = [root[k] if r == root[i] else r for r in root]
    groups = jaccard.near_groups(documents(rows), shingle=5, max_bits=0, second_bits=0, least=0.8)
    assert groups.select("component").distinct().count() == len(set(root)) < len(rows)


def test_a_large_bucket_is_compared_in_blocks(spark, documents, monkeypatch):
    """All texts share a frame, so they meet in buckets; blocks of 8 lose no link."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rnd = random.Random(7)
    frame, rows = [f"f{k}" for k in range(120)], []
    for g in range(40):
        own = frame + [f"w{rnd.getrandbits(30)}" for _ in range(70)]
        rows += [(2 * g, " ".join(own)), (2 * g + 1, " ".join(changed(rnd, own, 2)))]
    texts = dict(rows)
    root = list(range(80))
    for i in range(80):
        for k in range(i):
            if similarity(texts[i], texts[k]) >= 0.8:
                root = [root[k] if r == root[i] else r for r in root]
    groups = jaccard.near_groups(documents(rows), shingle=5, max_bits=0, second_bits=0, least=0.8)
    assert groups.select("component").distinct().count() == len(set(root)) < 60


def test_sets_travel_to_the_first_bucket_of_similar_texts_only(spark, documents, monkeypatch):
    """Strangers that share a frame meet in buckets, and similar texts meet in many: only the similar ones' sets come along, about once each."""
    rows_of, real = {}, jaccard.materialise

    def told(df, label):
        rows_of[label] = real(df, label)
        return rows_of[label]

    monkeypatch.setattr(jaccard, "materialise", told)
    rnd = random.Random(11)
    frame, rows = [f"f{k}" for k in range(90)], []
    for g in range(60):  # of 60 texts with a common frame, five have a near copy
        own = frame + [f"w{rnd.getrandbits(30)}" for _ in range(90)]
        rows.append((2 * g, " ".join(own)))
        if g < 5:
            rows.append((2 * g + 1, " ".join(changed(rnd, own, 2))))
    groups = jaccard.near_groups(documents(rows), shingle=5, max_bits=0, second_bits=0, least=0.8)
    assert groups.select("component").distinct().count() == 60
    assert rows_of["shared-bands"].count() > 20 and rows_of["sets"].count() == 10 and rows_of["met"].count() == 10


def test_sketches_tell_all_of_the_range():
    rnd, enough = np.random.default_rng(4), jaccard.enough_minima(0.8)
    agree = lambda a, b: sum(x == y for x, y in zip(*(jaccard.sketch_of(jaccard.minima_of(np.unique(s)))[: jaccard.HASHES] for s in (a, b)), strict=True))
    for n in (9, 60, 900):
        for _ in range(40):
            a = rnd.integers(0, 1 << 63, n, np.uint64)
            other = lambda k: np.concatenate([a[k:], rnd.integers(0, 1 << 63, k, np.uint64)])  # noqa: B023, E731
            assert agree(a, other(n // 9)) >= enough > agree(a, other(n - n // 4))


def test_bands_miss_nothing_of_the_range():
    rnd = np.random.default_rng(3)
    for n in (5, 60, 900, 9000):
        for _ in range(20):
            a = rnd.integers(0, 1 << 63, n, np.uint64)
            b = np.concatenate([a[n // 9 :], rnd.integers(0, 1 << 63, n // 9, np.uint64)])
            assert (jaccard.bands_of(np.unique(a)) == jaccard.bands_of(np.unique(b))).any()
    assert len(jaccard.shingle_set(b"", 5)) == 0 and len(jaccard.shingle_set(b"a b", 5)) == 1


def test_one_row_of_each_group_stays_whatever_its_id(documents):
    rnd = random.Random(9)
    one, two, three = (" ".join(f"{x}{rnd.randrange(5000)}" for _ in range(90)) for x in "abc")
    rows = [(1, one), (2, one + " more"), (2, two), (7, three), (7, three + " more"), (7, three), (None, two + " more"), (None, "x y z " * 9), (None, "x y z " * 9), (8, "alone")]
    got = cp.near_copies(None, documents(rows), "").collect()
    assert sorted(((r.doc_id, r.text[:1]) for r in got), key=repr) == sorted([(1, "a"), (2, "b"), (7, "c"), (None, "x"), (8, "a")], key=repr)
