import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
import xxhash
from pyspark.sql import functions as F

from quotewell.llm import mixing as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split_budget(budget, supply, weight):
    """By hand: siblings share by weight, pass after pass, those that are full drop out; whole tokens, what rounding leaves goes to the first by name."""
    got = {}

    def share(path, amount):
        if len(path) == 3:
            got[path] = amount
            return
        nodes = sorted({leaf[: len(path) + 1] for leaf in supply if leaf[: len(path)] == path})
        room = {n: sum(v for leaf, v in supply.items() if leaf[: len(n)] == n) for n in nodes}
        part, left, open_nodes, last = dict.fromkeys(nodes, Fraction(0)), Fraction(min(amount, sum(room.values()))), nodes, []
        while left > 0 and open_nodes:
            some = [n for n in open_nodes if weight(n) > 0] or open_nodes
            w = {n: Fraction(weight(n)).limit_denominator(10**6) if weight(some[0]) > 0 else Fraction(1) for n in some}
            want = {n: left * w[n] / sum(w.values()) for n in some}
            full = [n for n in some if want[n] >= room[n]]
            if not full:
                part, last = part | want, some
                break
            for n in full:
                part[n] = Fraction(room[n])
                left -= room[n]
            open_nodes = [n for n in open_nodes if n not in full]
        whole = {n: int(x) for n, x in part.items()}
        spare = int(sum(part.values())) - sum(whole.values())
        for n in last[:spare]:
            whole[n] += 1
        for n in nodes:
            share(n, whole[n])

    share((), budget)
    return got


def by_level(weight):
    """weight(path) of the tests as columns."""
    of = lambda k: F.udf(lambda d, x, s: float(weight((d, x, s)[: k + 1])), "double")(*(F.col(c) if j <= k else F.lit("") for j, c in enumerate(m.LEAF)))
    return of(0), of(1), of(2)


@pytest.fixture
def split(spark):
    def run(budget, supply, weight):
        leaves = spark.createDataFrame([(*k, n) for k, n in supply.items()], "domain string, lang string, source string, room long")
        return {(r.domain, r.lang, r.source): r.budget for r in m.budgets(leaves, budget=budget, weights=by_level(weight)).collect()}

    return run


def test_shortage_goes_to_siblings_first(split):
    supply = {("a", "x", "1"): 10, ("a", "x", "2"): 1000, ("a", "y", "1"): 1000, ("b", "x", "1"): 1000}
    assert split(400, supply, lambda p: 1) == {("a", "x", "1"): 10, ("a", "x", "2"): 90, ("a", "y", "1"): 100, ("b", "x", "1"): 200}


def test_shortage_of_a_subtree_goes_to_its_siblings(split):
    supply = {("a", "x", "1"): 10, ("a", "y", "1"): 1000, ("b", "x", "1"): 1000}
    assert split(400, supply, lambda p: 1) == {("a", "x", "1"): 10, ("a", "y", "1"): 190, ("b", "x", "1"): 200}
    supply[("a", "y", "1")] = 20
    assert split(400, supply, lambda p: 1) == {("a", "x", "1"): 10, ("a", "y", "1"): 20, ("b", "x", "1"): 370}
    assert sum(split(10**9, supply, lambda p: 1).values()) == sum(supply.values())


def test_weights_rounding_and_nothing(split):
    supply = {("a", "x", str(k)): 100 for k in range(3)}
    assert split(100, supply, lambda p: 1) == {("a", "x", "0"): 34, ("a", "x", "1"): 33, ("a", "x", "2"): 33}
    assert split(100, supply, lambda p: {"0": 3, "1": 1}.get(p[-1], 0) if len(p) == 3 else 1) == {("a", "x", "0"): 75, ("a", "x", "1"): 25, ("a", "x", "2"): 0}
    assert split(250, supply, lambda p: 0 if len(p) < 3 else float(p[-1] == "0")) == {("a", "x", "0"): 100, ("a", "x", "1"): 75, ("a", "x", "2"): 75}
    assert split(5, {}, lambda p: 1) == {}


def test_budgets_of_random_trees(split):
    rnd = random.Random(6)
    for _ in range(2):
        supply = {(rnd.choice("abc"), rnd.choice("xyz"), str(rnd.randint(0, 9))): rnd.choice([0, 1, 7, 100, 10**6, 3 * 10**12]) for _ in range(40)}
        w = {x: rnd.choice([0.0, 0.25, 1.0, 1 / 3, 2.5]) for x in "abcxyz0123456789"}
        for budget in (5, 999, sum(supply.values()) // 3):
            got = split(budget, supply, lambda p: w[p[-1]])
            want = split_budget(budget, supply, lambda p: round(w[p[-1]], 6))
            assert got == want and sum(got.values()) == min(budget, sum(supply.values()))


def corpus():
    rows = [(k, "w " * (1 + k * 7 % 23)) for k in range(300)] + [(300, None), (301, ""), (7, "w " * 50), (7, "w " * 50), (None, "a b c"), (302, "w " * 4000)]
    return rows


def leaf_of(i):
    return "d0", "en", f"src{(i or 0) % 4}"


def place(spark, i, seed, epoch):
    kind = F.lit(i).cast("bigint")
    return spark.range(1).select(m.place(kind, seed, F.lit(epoch).cast("long")).alias("p")).first().p


@pytest.mark.parametrize(("budget", "epochs", "ranges"), [(0.3, 1, 20_000), (0.3, 1, 7), (1.0, 1, 7), (1.5, 2, 7), (0.0, 1, 7)])
def test_against_brute_force(spark, documents, monkeypatch, budget, epochs, ranges):
    monkeypatch.setattr(m, "ROWS_A_RANGE", ranges)
    monkeypatch.setattr(m, "BROADCAST_LEAVES", 100 if ranges > 7 else 1)
    rows = corpus()
    weight = lambda p: {"src0": 5.0, "src1": 1.0, "src2": 1.0, "src3": 0.2}.get(p[-1], 1.0)
    out = m.mix(documents(rows), budget=budget, weights=by_level(weight), domain=F.lit("d0"), max_epochs=epochs, seed=9)
    got = sorted(((r.id, r.n, r.copies) for r in out.collect()), key=repr)
    leaves = defaultdict(list)
    for i, t in rows:
        leaves[leaf_of(i)].append((i, len(WORD.findall(t or ""))))
    supply = {k: sum(n for _, n in v) * epochs for k, v in leaves.items()}
    goal = split_budget(int(budget * sum(supply.values()) / epochs), supply, weight)
    ids = {i for i, _ in rows}
    order = {(i, e): p for e in range(epochs + 1) for i, p in zip(ids, _places(spark, ids, e), strict=True)}
    want = []
    for k, docs in leaves.items():
        total = sum(n for _, n in docs)
        whole, rest = divmod(goal[k], total) if total else (1, 0)
        upto, last = 0, None
        for i, n in sorted((d for d in docs if d[1]), key=lambda d: (order[d[0], whole], d[0] is not None, d[0] or 0)):
            upto += n
            if rest and 2 * upto - n <= 2 * rest:
                last = (order[i, whole], i is not None, i or 0)
        want += [(i, n, whole + (last is not None and (order[i, whole], i is not None, i or 0) <= last)) for i, n in docs]
    assert got == sorted(want, key=repr)


def _places(spark, ids, epoch):
    df = spark.createDataFrame([(k, i) for k, i in enumerate(ids)], "k int, i bigint")
    return [r.p for r in df.select("k", m.place(F.col("i"), 9, F.lit(epoch).cast("long")).alias("p")).orderBy("k").collect()]


def test_rows_of_the_mixture(documents):
    docs = documents(corpus())
    how = {"budget": 1.4, "weights": by_level(lambda p: 1.0), "domain": F.lit("d0"), "max_epochs": 2, "seed": 9}
    out = m.mixed_rows(docs, **how)
    assert out.columns == docs.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1 for r in out.collect()))
    want = sorted(i if i is not None else -1 for r in m.mix(docs, **how).collect() for i in [r.id] * r.copies)
    assert got == want


def test_production_leaves_and_empty(spark, documents):
    names = spark.createDataFrame([("src0",), ("src9",), ("src10",), ("src19",), ("other",), (None,), ("src99999999999",)], "source string")
    assert [r.d for r in names.select(m.production_domain().alias("d")).collect()] == ["d0", "d1", "d2", "d3", "d3", "d3", "d3"]
    leaf = spark.createDataFrame([("d0", "xx", "s"), ("d9", "de", "s")], "domain string, lang string, source string")
    assert [tuple(r) for r in leaf.select(*m.production_weights()).collect()] == [(0.4, None, 1.0), (None, 0.15, 1.0)]
    assert m.mix(documents([]), **m.production()).count() == 0 and m.mixed_rows(documents([]), **m.production()).count() == 0
    assert m.mix(documents([(1, None), (2, "")]), **m.production()).where("copies = 1").count() == 2
    assert xxhash.VERSION
