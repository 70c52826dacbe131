import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quotewell.llm import components, simhash as s

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, shingle):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[k : k + shingle]), seed=42) for k in range(max(1, len(words) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", " \n", "one", "One TWO", "a b c", "ÉÀ Straße x y z\x0bq", "w " * 50_000, "A B C D E F G É é"])
def test_fingerprint(text, monkeypatch):
    assert s.fingerprint(text.encode(), 3) == brute(text, 3)
    monkeypatch.setattr(s, "AT_ONCE", 2)
    assert s.fingerprint(text[:200].encode(), 3) == brute(text[:200], 3)


def test_spark_has_the_same_hash(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b é")).alias("h")).first().h % (1 << 64) == xxhash.xxh64_intdigest("a b é", seed=42)


def clusters(values, most):
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for k in range(i):
            if (values[i] ^ values[k]).bit_count() <= most:
                a, b = sorted((find(i), find(k)))
                root[b] = a
    return {v: find(i) for i, v in enumerate(values)}


@pytest.mark.parametrize(("most", "bits"), [(0, 64), (1, 64), (3, 64), (3, 12), (6, 20), (8, 64)])
def test_links_against_all_pairs(spark, most, bits):
    rnd = random.Random(most * 100 + bits)
    base = [rnd.getrandbits(bits) for _ in range(60)]
    values = list({b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, most + 1))) for b in base for _ in range(4)})
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, 0) for v in values], "fp long, fp2 long").repartition(3)
    roots = {r.node % (1 << 64): r.root for r in components.components(s.near_links(nodes, max_bits=most)).collect()}
    want = clusters(values, most)
    assert len(set(want.values())) == len({roots.get(v, v) if v in roots else v for v in values})
    groups = {}
    for v in values:
        groups.setdefault(want[v], set()).add(roots.get(v, v))
    assert all(len(g) == 1 for g in groups.values())


def test_large_group_makes_few_links(spark, monkeypatch):
    monkeypatch.setattr(s, "PAIRS", 64)
    values = [a << 32 | b for a in range(16) for b in range(16)]
    out = s.near_links(spark.createDataFrame([(v, 0) for v in values], "fp long, fp2 long"), max_bits=3)
    assert out.count() < 16 * len(values) and components.components(out).select("root").distinct().count() == 1


@pytest.mark.parametrize("most", [3, 5])
def test_a_common_value_is_cut_into_slices(spark, monkeypatch, most):
    """All fingerprints share 40 bits: without slices a part's value would be one key."""
    monkeypatch.setattr(s, "HOT_VALUE", 10)
    rnd = random.Random(4)
    values = list({(rnd.getrandbits(12) << 12) ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 2))) for _ in range(400)})
    fp = np.array(values, np.uint64)
    plan = s.Plan([list(range(16 * k, 16 * k + 16)) for k in range(4)], most)
    plan.learn(plan.histogram(fp), len(fp))
    stored = {}
    for key, cut, probe, own in plan.signatures(fp):
        if not probe:
            for x in zip(key.tolist(), cut.tolist(), strict=True):
                stored[x] = stored.get(x, 0) + 1
            assert len(own) == len(fp)
    keys = {}
    for (key, _), n in stored.items():
        keys[key] = keys.get(key, 0) + n
    assert max(keys.values()) > 100 and max(stored.values()) <= 40
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, 0) for v in values], "fp long, fp2 long").repartition(3)
    roots = {r.node % (1 << 64): r.root for r in components.components(s.near_links(nodes, max_bits=most)).collect()}
    want = clusters(values, most)
    groups = {}
    for v in values:
        groups.setdefault(want[v], set()).add(roots.get(v, v))
    assert all(len(g) == 1 for g in groups.values()) and len(set(want.values())) == len(set().union(*groups.values()))


def test_thresholds_sum_and_find_everything():
    rnd = np.random.default_rng(1)
    fp = rnd.integers(0, 1 << 63, 500, np.uint64)
    for most in (2, 3, 5):
        for n in (100, 10**7, 10**11):
            widths = s.widths_for(n, most)
            assert sum(widths) == 64
            plan = s.Plan(s.group_bits(np.eye(64), 500, widths), most)
            assert sorted(b for p in plan.parts for b in p) == list(range(64))
            plan.learn(plan.histogram(fp), 500)
            t = plan.thresholds(s._bits(fp))
            assert (t >= -1).all() and (t.sum(1) == most - len(widths) + 1).all()


def test_second_fingerprint(spark, documents):
    rnd = random.Random(8)
    values = list({(a ^ rnd.getrandbits(2), b ^ rnd.getrandbits(rnd.choice((3, 20)))) for a in (0, 1 << 40) for b in (0, 7 << 50) for _ in range(12)})
    nodes = spark.createDataFrame(values, "fp long, fp2 long")
    got = {r.node: r.root for r in components.components(s.near_links(nodes, max_bits=4, second_bits=5)).collect()}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for k in range(i):
            if (values[i][0] ^ values[k][0]).bit_count() <= 4 and (values[i][1] ^ values[k][1]).bit_count() <= 5:
                root[find(i)] = find(k)
    name = lambda v: f"{v[0]:016X}{v[1]:016X}"
    groups = {}
    for i, v in enumerate(values):
        groups.setdefault(find(i), set()).add(got.get(name(v), name(v)))
    assert len(groups) > 2 and all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)
    text = "one two three four five six seven eight nine ten eleven"
    assert s.fingerprint_pair(text.encode(), 3, True)[0] == brute(text, 3) and s.fingerprint_pair(text.encode(), 3, True)[1] != brute(text, 3)
    rows = [(1, text), (2, text), (3, "else " * 12), (4, None)]
    out = {r.doc_id: r.component_id for r in s.near_duplicates(documents(rows), shingle=5, max_bits=10, second_bits=16).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 4}


def test_documents(documents):
    rows = [(4, "a b c d e"), (2, "A b C d e"), (9, None), (7, ""), (None, "a b c d e"), (None, "q r s t"), (5, "a b c d e"), (5, "a b c d e"), (1, "zz " * 9), (3, "one two three four")]
    out = s.near_duplicates(documents(rows), shingle=3, max_bits=3)
    got = sorted(((r.doc_id, r.component_id) for r in out.collect()), key=repr)
    prints = [brute(t, 3) for _, t in rows]
    link = clusters(list(dict.fromkeys(prints)), 3)
    low = {}
    for (i, _), f in zip(rows, prints, strict=True):
        if i is not None:
            low[link[f]] = min(i, low.get(link[f], i))
    assert got == sorted(((i, low.get(link[f])) for (i, _), f in zip(rows, prints, strict=True)), key=repr)
    assert s.near_duplicates(documents([]), shingle=3, max_bits=3).count() == 0
    with pytest.raises(ValueError):
        s.near_duplicates(documents([]), shingle=0, max_bits=3)


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}
