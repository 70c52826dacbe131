import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quotewell.llm import token_align
from quotewell.llm.token_align import Aligner, Pair, align, aligned_rows, op13_token_align, pair_counts, production

SF = "/root/testdata/sf0.001"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def given():
    return production()


def intervals(table, ids):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at += len(table[i])
    return out


def brute(given, texts):
    """Whole texts by the libraries; every A token against every B token near it."""
    pair = Pair(given)
    docs = []
    for text in texts:
        want = (" " + (text or "")).encode()
        a = pair.a.encode(" " + (text or ""), add_special_tokens=False).ids
        b = pair.b.encode(text or "")
        if not text or b"".join(pair.a_bytes[i] for i in a) != want or b"".join(pair.b_bytes[i] for i in b) != want:
            docs.append(None)
            continue
        a, b = intervals(pair.a_bytes, a), intervals(pair.b_bytes, b)
        links, k = [], 0
        for s, e, i in a:
            while b[k][1] <= s:
                k += 1
            j = k
            while j < len(b) and b[j][0] < e:
                links.append((i, b[j][2]))
                j += 1
        ends = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        part = lambda side, lo, hi: ",".join(str(i) for s, e, i in side if lo < e <= hi)
        groups = ";".join(f"{part(a, lo, hi)}|{part(b, lo, hi)}" for lo, hi in zip([0, *ends], ends))
        docs.append((len(a), len(b), len(ends), links, groups))
    total = Counter(x for d in docs if d for x in d[3])
    most = {}
    for (_, b), n in total.items():
        most[b] = max(most.get(b, 0), n)
    return [(0,) * 6 + ("",) if d is None else (*d[:3], len(d[3]), sum(total[x] == most[x[1]] for x in d[3]), sum(total[x] for x in d[3]), hashlib.sha256(d[4].encode()).hexdigest()) for d in docs], total


def test_query_against_brute_force(spark, given):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], brute(given, [r.text for r in docs])[0]))
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in op13_token_align(spark, SF).collect()}
    assert got == want
    assert sum(v[3] > 0 for v in want.values()) > 150


ODD = ["<|endoftext|> and <s> </s> <unk>", "two  blanks", " lead", "trail ", "a\n\nb  c d\n", "naïve café über 世界 你好 ok", "▁ low line", "x▁y z", "  nbsp", "tab\tand\x1cfile sep", "don't we'll it's", "🙂🙂 🙂 a",
       "a", " ", "  ", "\n", "é combining ́x", "ﬁ ligature", "１２ wide", "\x00 nul", "<0x41> hex", "x" * 3000, "word " * 500]


def test_odd_texts_rare_pairs_and_caches(spark, given, documents, monkeypatch):
    monkeypatch.setattr(token_align, "REMEMBERED", 20)
    monkeypatch.setattr(token_align, "CHARS_AT_ONCE", 1000)
    rng = random.Random(2)
    words = "the of Quantum zebras analyse überall naïvely 12345 foo-bar http://x.y/z?q=1 ... MÜNCHEN straße ok\n end.".split(" ")
    texts = [*ODD, None, "", *[" ".join(rng.choice(words) for _ in range(40)) for _ in range(20)]]
    rows = [(k // 2 if k % 7 else None, t) for k, t in enumerate(texts)]
    want = sorted(((str(i), *v) for (i, _), v in zip(rows, brute(given, texts)[0])))
    for heavy in (1, 50, 1 << 20):  # all pairs rare, some, none
        got = sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in align(documents(rows), given, digest=True, heavy=heavy).collect())
        assert got == want, heavy


def test_pair_counts(given, documents):
    texts = ["the zebras ok", "the the end", None]
    total = brute(given, texts)[1]
    n = len(Pair(given).b_bytes)
    rows = aligned_rows(documents(list(enumerate(texts))), given, id_col="doc_id", text_col="text", digest=False)
    got = {(r.pair // n, r.b): r.total for r in pair_counts(rows, given).collect()}
    assert got == dict(total)


def test_groups_as_text(given, documents, collect):
    got = collect(align(documents([(1, "unbelievable naïvety"), (2, "")]), given))
    assert got[2].groups == "" and got[1].n_groups == got[1].groups.count(";") + 1
    a, b = Pair(given).a.encode(" unbelievable naïvety", add_special_tokens=False).ids, Pair(given).b.encode("unbelievable naïvety")
    sides = [g.split("|") for g in got[1].groups.split(";")]
    assert [int(i) for x, _ in sides for i in x.split(",")] == a and [int(i) for _, y in sides for i in y.split(",")] == b


def test_cut_texts_have_the_ids_of_whole_ones(spark, given):
    """On all texts of sf0.01 and the odd ones."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text] + ODD
    aligner = Aligner(given)
    assert aligner.pair.cuts
    places, count = aligner.chunks(texts)
    for text, own in zip(texts, np.split(places, np.cumsum(count)[:-1]), strict=True):
        if len(own):
            sides = [g.split("|") for c in own for g in aligner.groups[c].split(";")]
            assert [int(i) for x, _ in sides for i in x.split(",")] == aligner.pair.a.encode(" " + text, add_special_tokens=False).ids
            assert [int(i) for _, y in sides for i in y.split(",")] == aligner.pair.b.encode(text)


def test_empty_table(given, documents):
    assert align(documents([]), given).count() == 0
