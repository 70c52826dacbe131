import hashlib
import random
import time

import pytest
import tiktoken

from quotewell.llm import bpe

ODD = [
    None, "", " ", "  ", "\n", " a  b\n\n c\t d ", "it's we'll I'D x　y\x1c z\x85q", "日本語 ñandú 12345 ３４", "a\r\nb", "x \n\n", "   x", "é \x00 \ud7ff", "<|endoftext|> a", "a" * 5000,
    "the the the.the, the", "ab\u2028 c\u00a0d e\u200bf", "𝔘nicode 🙂🙂 ok", "it's\n's 're",
]


@pytest.fixture(scope="module")
def public():
    tokenizers = pytest.importorskip("public_tokenizers")
    ranks = bpe.read_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return ranks, tokenizers.PATTERN, tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library(documents, public, monkeypatch):
    ranks, pattern, library = public
    rows = list(enumerate(ODD)) + [(None, "no id"), (4, "\n")]
    ids = sorted(((r.doc_id, r.ids) for r in bpe.encode(documents(rows), ranks, pattern).collect()), key=repr)
    assert ids == sorted(((i, library.encode_ordinary(t or "")) for i, t in rows), key=repr)
    got = sorted((tuple(r) for r in bpe.round_trip(documents(rows), ranks, pattern).collect()), key=repr)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == sorted(((i, len(x), sha(",".join(map(str, x)).encode()), sha((t or "").encode())) for i, t in rows for x in [library.encode_ordinary(t or "")]), key=repr)


def test_decode(spark, documents, public):
    ranks, pattern, _ = public
    back = bpe.decode(bpe.encode(documents(list(enumerate(ODD))), ranks, pattern), ranks, pattern)
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == {i: t or "" for i, t in enumerate(ODD)}
    lone = spark.createDataFrame([(1, [ranks[b"\xff"]]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(lone, ranks, pattern).collect()} == {1: b"\xff", 2: b"", 3: b""}
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), ranks, pattern).collect()


def test_small_caches_and_queries_change_nothing(public, monkeypatch):
    ranks, pattern, library = public
    for name, value in {"REMEMBERED": 2, "QUERY_CHARS": 5, "QUERY_TOKENS": 3}.items():
        monkeypatch.setattr(bpe, name, value)
    codec = bpe.Codec(ranks, pattern)
    texts = [t or "" for t in ODD]
    for _ in range(2):
        ids = codec.encode(texts)
        assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts] and codec.decode(ids) == [t.encode() for t in texts]


def test_leftmost_least_rank_first():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 257, b"aab": 258, b"ba": 259, b"aaaa": 260}
    codec = bpe.Codec(ranks, r"(?s).+")
    for text in ("aaa", "aaab", "abab", "baab", "aaaaaaa", "bbaaabab"):
        parts = [bytes([b]) for b in text.encode()]
        while pairs := [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]:
            _, k = min(pairs)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert codec.encode([text])[0].tolist() == [ranks[p] for p in parts]
    with pytest.raises(ValueError, match="lacks"):
        bpe.Codec({b"a": 0}, ".")


def by_hand(text, ranks):
    parts = [bytes([b]) for b in text.encode()]
    while pairs := [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]:
        _, k = min(pairs)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return [ranks[p] for p in parts]


def test_long_pieces_keep_the_order(monkeypatch):
    """Ranks below their parts': a contraction may make a lower pair, before the next of the minimum's turn."""
    monkeypatch.setattr(bpe, "LONG", 5)
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 300, b"ab": 301, b"aab": 258, b"ba": 259, b"aaaa": 260, b"abab": 299, b"aba": 262, b"bab": 263, b"abcab": 264, b"cc": 265}
    codec, rnd = bpe.Codec(ranks, r"(?s).+"), random.Random(2)
    for _ in range(300):
        text = "".join(rnd.choices("aabc", k=rnd.randint(1, 40)))
        assert codec.encode([text])[0].tolist() == by_hand(text, ranks)


def test_very_long_pieces_in_bounded_time(public):
    ranks, pattern, library = public
    codec, rnd = bpe.Codec(ranks, pattern), random.Random(1)
    for text in ("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=100_000)), "a" * 100_000, "ab" * 20_000, "é" * 9_999, "thequickbrownfox" * 3_000, " " * 30_000, "=-" * 9_000):
        began = time.time()
        assert codec.encode([text])[0].tolist() == library.encode_ordinary(text)
        assert time.time() - began < 20  # pair by pair they take minutes


@pytest.mark.parametrize("pattern", [r"\S+| +|\s", r"(?s).", r" ?[a-z]+ ?|(?s)."])
def test_other_patterns_are_not_cut_at_blanks(public, pattern):
    ranks, _, _ = public
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(ranks, pattern)
    for text in ("one two three", " a  b c", "x y.z w"):
        assert codec.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_empty(documents, public):
    ranks, pattern, _ = public
    assert bpe.encode(documents([]), ranks, pattern).count() == 0 and bpe.round_trip(documents([]), ranks, pattern).count() == 0
