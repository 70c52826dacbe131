import random

import numpy as np
import pytest

from quotewell.llm import substring_dedup as s
from quotewell.llm.bwt import long_prefixes


def expected(rows, length):
    from collections import Counter

    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        cut = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                cut[k : k + length] = True
        edge = np.diff(np.concatenate([[0], cut.astype(int), [0]]))
        spans = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
        out.append((i, len(b), spans, bytes(np.frombuffer(b, np.uint8)[~cut])))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(x) for x in r.spans], bytes(r.kept)) for r in df.collect()), key=repr)


def corpus(seed, n=40):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdeé ", k=rnd.randint(2, 9)))
    passages = [" ".join(word() for _ in range(rnd.randint(5, 40))) for _ in range(6)]
    rows = []
    for k in range(n):
        parts = [rnd.choice(passages) if rnd.random() < 0.4 else " ".join(word() for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(1, 5))]
        rows.append((k, "|".join(parts)))
    return [*rows, (n, rows[0][1]), (n + 1, rows[0][1]), (n + 2, None), (n + 3, ""), (n + 4, "a" * 500), (n + 5, "ab" * 300), (n + 6, "x"), (None, rows[1][1]), (3, rows[3][1])]


@pytest.mark.parametrize("length", [40, 64])
def test_against_brute_force(documents, length):
    rows = corpus(length)
    assert rows_of(s.substring_dedup(documents(rows), length=length, k=16)) == expected(rows, length)


def test_anchors_with_very_many_contexts(documents, monkeypatch):
    monkeypatch.setattr(s, "HOT_CONTEXTS", 3)
    monkeypatch.setattr(s, "BIN_BYTES", 500)
    rows = corpus(5)
    assert rows_of(s.substring_dedup(documents(rows), length=48, k=16)) == expected(rows, 48)


def test_long_texts_are_hashed_in_stretches(documents, monkeypatch):
    monkeypatch.setattr(s, "STRETCH", 128)
    rows = corpus(7)
    whole = s.anchors(rows[0][1].encode() * 9, 40, 16)
    assert len(whole[0]) == len(whole[3]) and (np.diff(whole[2]) > 0).all()
    assert s.substring_dedup(documents(rows), length=40, k=16).count() == len(rows)


def test_equal_windows_have_equal_anchors():
    text = bytes(random.Random(1).choices(range(256), k=3000))
    found = {}
    for shift in (0, 7, 300):
        place, h, first, last = s.anchors(b"." * shift + text, 400, 32)
        for p, x, a, z in zip(place, h, first, last, strict=True):
            for w in range(a, z + 1):
                if w >= shift:
                    found.setdefault(w - shift, set()).add((int(p) - shift, int(x)))
    assert len(found) == 2601 and all(len(v) == 1 for v in found.values())


def test_prefixes_against_brute_force():
    rnd = random.Random(2)
    for _ in range(20):
        text = [rnd.randint(1, 3) for _ in range(rnd.randint(30, 200))] + [0]
        text += text[: rnd.randint(0, len(text))] + [0]
        symbols = np.array(text, np.int16)
        sa, ends = long_prefixes(symbols, 32)
        for i in range(1, len(sa)):
            a, b = int(sa[i - 1]), int(sa[i])
            x, y = tuple(text[a : a + 32]), tuple(text[b : b + 32])
            if 0 not in x and 0 not in y and len(x) == len(y) == 32:
                assert bool(ends[i]) == (x != y)


def spans_text(rnd, n, letters="abcdefghij", size=5):
    return " ".join("".join(rnd.choices(letters, k=rnd.randint(1, size))) for _ in range(n))


@pytest.mark.parametrize("batch", [10_000, 7])
def test_passages_of_over_50_words_are_told(spark, documents, batch):
    """51 words of another document, in fewer than 400 bytes; copies; 25 words don't count; rows equal in id and text are one document."""
    rnd = random.Random(11)
    own = [spans_text(rnd, rnd.randint(60, 200)) for _ in range(60)]
    passage, short = spans_text(rnd, 51), spans_text(rnd, 25)
    assert len(passage) < 400
    rows = [(k, t) for k, t in enumerate(own)]
    rows += [(100 + k, f"{spans_text(rnd, 7 * k)} {passage}\n {spans_text(rnd, 30)}") for k in range(6)]
    rows += [(200 + k, f"{spans_text(rnd, 40)} {short} {spans_text(rnd, 40)}") for k in range(3)]
    rows += [(300, own[0]), (301, own[1]), (400, spans_text(rnd, 80)), (500, None), (501, "")]
    rows += [rows[-3]] * 2
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    got = {r.doc_id: r.n_shared for r in s.substring_dedup(documents(rows)).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    told = {k for k, n in got.items() if n}
    assert told == {0, 1, 300, 301, *range(100, 106)}
    hashes = lambda t: np.array([s.xxh3_64_intdigest(w) for w in t.encode().split()], np.uint64)
    assert got[0] == got[300] == len(s.least_shingles(hashes(own[0]), s.PASSAGE_SHINGLE, s.PASSAGE_WINDOW))


def test_very_long_texts(documents):
    """Texts of several stretches: the second repeats the middle of the first, across a stretch's border."""
    rnd = random.Random(5)
    long = "".join(rnd.choices("abcdefgh ", k=3 * s.STRETCH // 2))
    part = long[s.STRETCH - 3000 : s.STRETCH + 3000]
    rows = [(1, long), (2, "x" + part + "y"), (3, long[:399]), (4, "z" * (s.STRETCH + 1000))]
    got = {r[0]: r for r in rows_of(s.substring_dedup(documents(rows)))}
    assert got[1][2] == [(s.STRETCH - 3000, s.STRETCH + 3000)] and got[2][2] == [(1, 6001)] and got[3][2] == []
    assert got[4][2] == [(0, s.STRETCH + 1000)] and got[1][3].decode() == long[: s.STRETCH - 3000] + long[s.STRETCH + 3000 :]


def test_empty(documents):
    assert s.substring_dedup(documents([])).count() == 0
    with pytest.raises(ValueError):
        s.substring_dedup(documents([]), length=40, k=32)
    assert s.merged([(5, 9), (0, 3), (3, 5), (20, 21)]) == [(0, 9), (20, 21)]
