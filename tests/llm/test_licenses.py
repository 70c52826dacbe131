import re
from itertools import combinations

import pytest

from quotewell.llm import licenses as li

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    at, labels = [], set()
    for phrase, label in li.BASE_PHRASES:
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                at.append(k)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


MIT = li.TEMPLATES[9].text
BSD = next(t.text for t in li.TEMPLATES if t.label == "bsd")
CASES = [
    (1, "Code.\nReleased under the MIT License.\nMore under THE mit license", "mit"), (2, "Licensed under the Apache License, Version 2.0. cc-by-nc", "apache-2,cc-by-nc"), (3, None, ""), (4, "", ""),
    (5, "x " * 30_000 + MIT + " y" * 30_000, "mit"), (6, "under the mit licenses and the license of mit", ""), (7, "/* " + BSD.replace(" ", "\n * ") + " */", "bsd"), (8, "This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    (9, "straße_under the mit license2 É", ""), (10, BSD.replace("source", "sauce") + " " + MIT, "mit"), (11, "license version public general gnu terms conditions software", ""), (12, "under under the mit license version 2 apache license version 2", "apache-2,mit"),
    (None, "cc by nc", "cc-by-nc"),
]


def test_against_brute_force(documents):
    rows = [(i, t) for i, t, _ in CASES] + [(1, CASES[0][1])]
    out = li.scan_licenses(documents(rows)).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    for i, text, labels in CASES:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text), i
        assert r.labels == labels and 0 <= r.score <= 1 and (r.score > 0) == bool(labels), i
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_changed_notice_still_fits_but_needs_its_key_phrase(documents):
    near = MIT.replace("person", "human").replace("free of charge", "free of any charge")
    broken = MIT.replace("without restriction", "with restriction")
    got = {r.doc_id: r.labels for r in li.scan_licenses(documents([(1, near), (2, broken)])).collect()}
    assert got == {1: "mit", 2: ""}


def test_rare_words_come_first():
    index = li.LicenseIndex(li.TEMPLATES, {})
    assert index.match([]) == {} and index.match([b"zzz"]) == {}
    assert all(index.labels[t] == label and s == 1.0 for label, text in [(t.label, t.text) for t in li.TEMPLATES[9:11]] for t, s in index.match(li.words_of(text.encode())).items())


def test_each_notice_of_a_file_is_found():
    index = li.LicenseIndex(li.TEMPLATES, {})
    for chosen in combinations(range(len(li.TEMPLATES)), 4):
        text = " and so on ".join(li.TEMPLATES[t].text for t in chosen)
        assert set(chosen) <= index.match(li.words_of(text.encode())).keys(), chosen


def test_frequencies_and_empty(documents):
    total, counts = li.document_frequency(documents([(1, "mit MIT"), (2, "mit"), (3, None)]), {b"mit", b"gnu"})
    assert (total, counts) == (3, {b"mit": 2})
    assert li.scan_licenses(documents([])).count() == 0


@pytest.mark.parametrize(("text", "phrase", "places"), [("a b a b a b", "a b", [0, 2, 4]), ("a a a", "a a", [0, 1]), ("x", "a b", [])])
def test_places(text, phrase, places):
    assert li.phrase_places(li._spread(text.encode().split()), li._spread(phrase.encode().split())) == places
