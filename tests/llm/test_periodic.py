import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from quotewell.llm import periodic
from quotewell.llm.periodic import collapse, find_runs, op12_periodic_runs, periodic_runs, run_digests

SF = "/root/testdata/sf0.001"


def smallest_period(w):
    """By borders."""
    fail, k = [0] * len(w), 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k - 1]
        k += w[i] == w[k]
        fail[i] = k
    return len(w) - fail[-1]


def naive_runs(w):
    """Every stretch that no neighbour extends at some lag, tried one by one, with its smallest period by borders."""
    out = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q) and smallest_period(w[i : j + q]) == q:
                out.add((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), max_size=5))
def test_runs_against_brute_force(texts):
    assert find_runs(texts) == [naive_runs(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=7), st.integers(1, 9), st.text("abcd", max_size=5)), max_size=6))
def test_planted_powers(parts):
    word = list("".join(p * k + rest for p, k, rest in parts))
    assert find_runs([word, word[::-1], word[1:]]) == [naive_runs(word), naive_runs(word[::-1]), naive_runs(word[1:])]


def test_texts_that_share_planes_do_not_touch():
    half = ["a", "b"] * 2
    assert find_runs([half, half, half]) == [[], [], []]
    assert find_runs([["x"] * 5, ["x"] * 6, ["x"] * 5]) == [[], [(0, 6, 1)], []]


def test_collapse_keeps_the_first_period():
    words = list("zabababacabc")
    assert find_runs([words]) == [[(1, 7, 2)]] or naive_runs(words) == find_runs([words])[0]
    assert collapse(list("xabababab"), [(1, 8, 2)]) == list("xab")
    assert collapse(list("aaaaaabb"), [(0, 6, 1)]) == list("abb")


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = naive_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_against_brute_force(spark):
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in op12_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    assert sum(v[0] > 0 for v in got.values()) > 10
    for r in docs:
        assert got[r.doc_id] == expected(r.doc_id, r.text), r.doc_id


def test_odd_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(periodic, "WORDS_AT_ONCE", 50)
    rng = random.Random(3)
    long = " ".join(rng.choice(["in", "the", "end", f"w{rng.randrange(500)}"]) for _ in range(4000)) + " so it goes" * 900
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (6, "é ü " * 4), (7, "a b c " * 5), (None, "x y " * 8), (8, long), (8, long), (9, "one"), (30, "b " * 50)]
    got = sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in run_digests(documents(rows), rewrite=periodic.planted).collect())
    assert got == sorted((str(i), *expected(i, t)) for i, t in rows)
    assert run_digests(documents([])).count() == 0


def test_runs_and_texts(documents, collect):
    got = collect(periodic_runs(documents([(1, "go go go go go go stop"), (2, "no run"), (3, None)])))
    assert [tuple(x) for x in got[1].runs] == [(0, 6, 1)] and got[1].collapsed == "go stop"
    assert got[2].runs == [] and got[2].collapsed == "no run" and got[3].collapsed == ""


def test_a_million_words_take_few_lags():
    rng = random.Random(4)
    words = [f"w{rng.randrange(3000)}" for _ in range(1_000_000)]
    words[200_000:600_000] = (words[200_000:290_000] * 5)[:400_000]
    assert find_runs([words]) == [[(200_000, 400_000, 90_000)]]
