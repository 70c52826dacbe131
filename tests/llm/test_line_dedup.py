import random

import pytest

from quotewell.llm.line_dedup import later_runs, line_dedup, repeated_windows


def expected(rows, n, words=51):
    """Windows of n lines, and lines of so many words, that start earlier elsewhere are cut; of equal rows the first is first."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, cut = (t or "").split("\n"), set()
        for k in range(len(lines) - n + 1):
            w = tuple(lines[k : k + n])
            if w in seen:
                cut |= set(range(k, k + n))
            seen.add(w)
        for k, x in enumerate(lines):
            if len(x.split()) >= words and n > 1:
                if x in seen:
                    cut.add(k)
                seen.add(x)
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in cut), len(lines), sorted(cut)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.n_lines, list(r.removed)) for r in df.collect()), key=repr)


CASES = [(1, "a\nb\nc\nd"), (2, "x\nb\nc\ny"), (3, "b\nc"), (4, "A\nA\nA\nA"), (5, None), (6, ""), (7, "a\nb\nc\nd"), (8, "\n\n\n"), (9, "a\nb\nq\nc\nd"), (None, "u\nv")]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_against_brute_force(documents, n):
    assert rows_of(line_dedup(documents(CASES), min_lines=n)) == expected(CASES, n)


def test_random_documents(documents):
    rnd = random.Random(3)
    rows = [(k, "\n".join(rnd.choices("abcdefgh", k=rnd.randint(0, 12)))) for k in range(60)]
    for n in (2, 3):
        assert rows_of(line_dedup(documents(rows), min_lines=n)) == expected(rows, n)


def test_single_lines_of_many_words(documents):
    """A passage of 51 words on one line goes where it comes again, between any neighbours; one of 50 stays."""
    long, short = " ".join(f"w{k}" for k in range(51)), " ".join(f"v{k}" for k in range(50))
    rows = [(1, long), (2, f"a\n{long}\nb"), (3, short), (4, f"c\n{short}\nd"), (5, f"{long}\n{long}\ne"), (6, long), (7, f"{long} x"), (None, f"z\n{short}")]
    assert rows_of(line_dedup(documents(rows))) == expected(rows, 2)
    assert rows_of(line_dedup(documents(rows), long_words=50)) == expected(rows, 2, 50)
    assert rows_of(line_dedup(documents(rows), long_words=None)) == expected(rows, 2, 10**9)


def test_very_long_texts(documents):
    """A text of 30,000 lines, half of which stand in another, and a line of 200,000 words."""
    many = [f"line {k}" for k in range(30_000)]
    rows = [(1, "\n".join(many)), (2, "\n".join(["x", *many[:15_000], "y"])), (3, "w " * 200_000), (4, "q\n" + "w " * 200_000)]
    assert rows_of(line_dedup(documents(rows))) == expected(rows, 2)


def test_equal_rows(documents):
    out = rows_of(line_dedup(documents([(1, "a\nb"), (1, "a\nb"), (2, "c")])))
    assert out == [(1, "", 2, [0, 1]), (1, "a\nb", 2, []), (2, "c", 1, [])]


def test_runs_and_empty(documents):
    out = {r.doc_id: [tuple(x) for x in r.runs] for r in line_dedup(documents([(1, "a\nb\nc\nd\ne"), (2, "a\nb\nx\nd\ne")])).collect()}
    assert out == {1: [], 2: [(0, 2), (3, 5)]}
    assert line_dedup(documents([])).count() == 0
    with pytest.raises(ValueError):
        line_dedup(documents([]), min_lines=0)


def test_doubling_goes_on_until_nothing_repeats(documents):
    """13 lines in common: windows of 8 still repeat, windows of 16 don't; the later copies make one run."""
    shared = [f"s{k}" for k in range(13)]
    docs = documents([(1, "\n".join(shared)), (2, "\n".join(["x", *shared, "y"]))])
    at = repeated_windows(docs)
    assert sorted((r.doc, r.span, r.i) for r in at.collect()) == sorted((d, h, i + d - 1) for d in (1, 2) for h in (2, 4, 8) for i in range(14 - h))
    assert [(r.own[0].start, r.own[0].stop) for r in later_runs(at).collect()] == [(1, 14)]
