import math
import random
import re
from collections import Counter

import pytest

from quotewell.llm import url_filter as u

CASES = [
    ("https://A.Example.com/en/7?x", "a.example.com", "/en/7", "example.com/en/7", "allow"), ("http://x.com/en/8", "x.com", "/en/8", "com/en/", "block"), ("http://notcom/en/8", "notcom", "/en/8", None, None),
    ("http://example.net/de/8#a", "example.net", "/de/8", "example.net/de/8", "block"), ("http://example.net/de/9", "example.net", "/de/9", "net/de/", "allow"), ("http://myexample.net/de/8", "myexample.net", "/de/8", "net/de/", "allow"),
    ("no scheme/en/", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None), ("a://b://c/d", "b:", "//c/d", None, None), ("x://HOST?q/y", "host", "", None, None), ("x://ÀB.org/es/É", "Àb.org", "/es/É", "org/es/", "block"),
    ("x://org/es/", "org", "/es/", "org/es/", "block"), ("x://com/en", "com", "/en", None, None), ("x://", "", "", None, None),
]


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(k, url, html, "x", "y") for k, url, html in rows], "page_id bigint, url string, html string, rule string, id string").repartition(2)


def test_rules(pages):
    out = u.judge_urls(pages([(k, x[0], None) for k, x in enumerate(CASES)] + [(0, CASES[0][0], None)])).collect()
    assert len(out) == len(CASES) + 1
    got = {r.page_id: r for r in out}
    for k, (_, host, path, rule, verdict) in enumerate(CASES):
        assert (got[k].host, got[k].path, got[k]["rule"]) == (host, path, rule), k
        assert got[k].verdict == verdict if rule else got[k].verdict in ("allow", "block")


def test_segmentation():
    counts = {"cheap": 50, "pills": 40, "online": 60, "on": 100, "line": 80, "a": 200}
    split = lambda text: u.Segmenter(sum(counts.values())).split(text, counts)
    assert split("cheappillsonline") == ["cheap", "pills", "online"] and split("") == []
    assert "".join(split("qqqcheapzz")) == "qqqcheapzz" and "cheap" in split("qqqcheapzz")
    assert "".join(split("x" * 200)) == "x" * 200


def best_split(text, cost, unknown):
    """All splits, the cheapest."""
    if not text:
        return 0.0
    return min((cost[text[:k]] if text[:k] in cost else unknown + k * math.log(10)) + best_split(text[k:], cost, unknown) for k in range(1, min(len(text), u.MAX_WORD) + 1))


@pytest.mark.parametrize("text", ["spamfarm", "ababa", "cabbage", "aabbcc"])
def test_viterbi_is_the_cheapest_split(text):
    counts = {"spam": 5, "farm": 4, "a": 9, "ab": 7, "ba": 6, "cab": 3, "bage": 2, "cc": 5}
    s = u.Segmenter(sum(counts.values()))
    cost = {w: -math.log(n / s.total) for w, n in counts.items()}
    assert abs(sum(cost[w] if w in cost else s.unknown + len(w) * math.log(10) for w in s.split(text, counts)) - best_split(text, cost, s.unknown)) < 1e-9


def by_hand(rows):
    """Words, score and verdict of every url, by dictionaries over all words, without buckets."""
    text = lambda url, html: re.sub("<[^>]*>", " ", html or "") + " " + (re.search("://[^/?#]*([^?#]*)", url or "") or [0, ""])[1]
    counts = Counter(w for _, url, html in rows for w in re.findall("[a-z]+", text(url, html).lower()))
    counts |= {w: max(counts[w], u.LEXICON_COUNT) for w in u.LEXICON}
    splitter = u.Segmenter(sum(counts.values()))
    words = lambda part: [w for r in u.runs_of(part) for w in (splitter.split(r, counts) if r.isascii() and r.isalpha() else [r])]
    told = []
    for k, url, _ in rows:
        host, path = u.split_url(url)
        told.append((k, words(host), words(path)))
    bad = [not set(u.LEXICON).isdisjoint(h) for _, h, _ in told]
    seen = [Counter(x for (_, h, p), b in zip(told, bad, strict=True) if b is kind for x in [("h", w) for w in h] + [("p", w) for w in p]) for kind in (False, True)]
    every = set(seen[0]) | set(seen[1])
    odds = {x: math.log((seen[1][x] + u.ALPHA) / (seen[1].total() + u.ALPHA * len(every))) - math.log((seen[0][x] + u.ALPHA) / (seen[0].total() + u.ALPHA * len(every))) for x in every}
    prior = math.log(sum(bad) / (len(bad) - sum(bad)))
    return {k: (" ".join(h), prior + sum(odds["h", w] for w in h) + sum(odds["p", w] for w in p)) for k, h, p in told}


def test_words_odds_and_verdicts_agree_with_a_count_by_hand(pages):
    """One url in a hundred is bad: the rare class isn't swamped."""
    rng = random.Random(3)
    names = ["library", "museum", "garden", "river", "station", "school"]
    rows = [(k, f"http://{rng.choice(names)}{rng.choice(names)}.test/{rng.choice(names)}/{k % 7}", f"<p>{' '.join(rng.choices(names, k=8))} Long{'x' * 90}</p>") for k in range(990)]
    rows += [(1000 + k, f"http://www.cheap{rng.choice(['spam', 'pills', 'casino'])}.test/buy/{rng.choice(names)}", "<b>cheap now</b>") for k in range(10)]
    rows += [(2000, None, None), (2001, "http://cheap.test/buy/now", ""), (2002, "http://x:1/", "a"), (2003, "http://" + "garden" * 300 + ".test/", "")]
    want, got = by_hand(rows), {r.page_id: r for r in u.judge_urls(pages(rows)).collect()}
    assert len(got) == len(rows)
    for k, (words, score) in want.items():
        assert got[k].words == words and abs(got[k].score - score) < 1e-6, k
        assert got[k].verdict == ("block" if score > 0 else "allow")
    assert all(got[1000 + k].verdict == "block" for k in range(10)) and all(got[k].verdict == "allow" for k in range(990))
    assert got[2001].verdict == "block"


def test_empty_and_one_sided(pages):
    assert u.judge_urls(pages([])).count() == 0
    assert {r.verdict for r in u.judge_urls(pages([(1, "http://books.test", "books"), (None, "http://a.test", None)])).collect()} == {"allow"}
    found = {r.w: r.n for r in u.unigrams(pages([(1, "http://h/x", "<a>one</a> two two " + "y" * 30)]), url_col="url", html_col="html").collect()}
    assert found["two"] == 2 and found["x"] == 1 and found["y" * 30] == 1 and all(found[w] == u.LEXICON_COUNT for w in u.LEXICON)


def test_very_long_urls_and_common_words(pages):
    """Every url holds the same words; one has a path of 200,000 letters."""
    rows = [(k, "http://www.spam.test/a/b", "spam") for k in range(300)] + [(900, "http://w.test/" + "ab" * 100_000, ""), (901, "http://w.test/", "")]
    got = {r.page_id: r for r in u.judge_urls(pages(rows)).collect()}
    assert len(got) == 302 and got[900].path == "/" + "ab" * 100_000 and got[5].verdict == "block"
