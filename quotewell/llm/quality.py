"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and word pairs are hashed into BUCKETS. One multinomial is counted over every document (raw), one over a trusted
target: labelled rows of good quality that are not toxic. A document's score is the mean, over its n-grams, of
log(target / raw), the target smoothed towards raw; the mean makes it independent of length. A document is kept at
the threshold or above, by arithmetic alone: no draw, no rank among others.

The classifier is fitted on at most MAX_LABELLED labelled rows, those with the smallest hash of their id: half of them feed the target,
the other half, unseen, sets the threshold. Raw counts cover all documents. A task returns its counts as one row, and rows are
summed by bucket, so counts grow with tasks and never with vocabulary.

Cases: a null text has no words; a document without words scores 0 and fails the base rules. Labels that are null, repeated or of unknown ids do
no harm: a row is trusted if any of its labels says so. Without good or bad labels the threshold is NO_THRESHOLD and the base rules decide alone.
Ties with the threshold are kept; of held-out rows with one id the least score counts. Texts of any length are read whole, one at a time. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import load, to_python

BUCKETS = 1 << 16
MAX_LABELLED = 20_000
#: Tokens of the raw distribution mixed into the target's counts.
PRIOR = 20_000.0
#: Dropping a good labelled row costs as much as keeping so many bad ones.
GOOD_WORTH = 10
NO_THRESHOLD = -1e9
MIN_WORDS, MAX_REPEAT_SHARE = 50, 0.5

SPACE = b"\t\n\x0b\x0c\r "
SYMBOLS = b"#*$%&|<>"
#: Distinct words that a task remembers between documents. Only a cache: beyond it the task forgets and starts again.
REMEMBERED = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Numbers words in order of sight and keeps a 64-bit hash of each."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.hashes = np.zeros(1 << 12, np.uint64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.number) > REMEMBERED:
            self.forget()
        known, old = self.number, len(self.number)
        out = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        if len(known) > old:
            if len(known) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros(max(len(known), len(self.hashes)), np.uint64)])
            fresh = list(islice(reversed(known), len(known) - old))[::-1]
            self.hashes[old : len(known)] = [xxh3_64_intdigest(w) for w in fresh]
        return out

    def buckets(self, numbers: np.ndarray) -> np.ndarray:
        h = self.hashes[numbers]
        pairs = (h[:-1] * _ODD) ^ h[1:]
        pairs = (pairs ^ (pairs >> np.uint64(29))) * _ODD
        return np.concatenate([h >> np.uint64(48), pairs >> np.uint64(48)]).astype(np.int64)


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, raw, good = Words(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text, trusted in zip(batch["text"], batch["trusted"].to_pylist(), strict=True):
            b = words.buckets(words.numbers((text.as_buffer().to_pybytes() if text.is_valid else b"").split()))
            found = np.bincount(b, minlength=BUCKETS) if len(b) > 20_000 else None
            for table in (raw, good) if trusted else (raw,):
                if found is not None:
                    table += found
                else:
                    np.add.at(table, b, 1)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "raw": pa.array(raw[at], pa.int64()), "good": pa.array(good[at], pa.int64())})


def ngram_model(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, list, list]:
    """The log ratio of each bucket, and the ids of held-out good and bad rows."""
    by_id = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.max(((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int")).alias("good"), F.min("quality").alias("quality")
    )
    rank = F.xxhash64(F.col("doc_id"), F.lit(17))
    # hashes are even: those below this share of their range are about MAX_LABELLED rows, of which no task need sort more
    share = min(1.0, 1.02 * MAX_LABELLED / max(1, by_id.count()))
    below = int(-(2**63) + share * (2**64 - 2048))
    picked = by_id.withColumn("rank", rank).where(F.col("rank") <= below).orderBy("rank", "doc_id").limit(MAX_LABELLED).collect()
    trusted = [r.doc_id for r in picked if r.good and r.rank & 1]
    held_good, held_bad = [r.doc_id for r in picked if r.good and not r.rank & 1], [r.doc_id for r in picked if not r.good and r.quality == 0]
    is_trusted = F.col(id_col).isin(trusted) if trusted else F.lit(False)
    rows = to_python(docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(is_trusted, F.lit(False)).alias("trusted")))
    counted = rows.mapInArrow(_counting, "bucket int, raw long, good long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).collect()
    raw, good = np.full(BUCKETS, 0.5), np.zeros(BUCKETS)  # half a token, for what has never been seen
    for r in counted:
        raw[r.bucket] += r.raw
        good[r.bucket] += r.good
    p = raw / raw.sum()
    ratio = np.log((good + PRIOR * p) / (good.sum() + PRIOR)) - np.log(p)
    return ratio, held_good, held_bad


def threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """Between two scores, where lost good rows, GOOD_WORTH each, and kept bad rows cost least; the lowest of equals."""
    if not len(good) or not len(bad):
        return NO_THRESHOLD
    at = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[at[0] - 1.0], (at[1:] + at[:-1]) / 2])
    lost = np.searchsorted(np.sort(good), cuts, "left")
    left = len(bad) - np.searchsorted(np.sort(bad), cuts, "left")
    return float(cuts[np.argmin(GOOD_WORTH * lost + left)])


SCORED = "id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double, base_failed boolean"


def _scoring(ratio: np.ndarray):
    words = Words()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [[] for _ in range(6)]
            for x in batch["text"]:
                for c, v in zip(cols, measure(x.as_buffer().to_pybytes() if x.is_valid else b"", words, ratio), strict=True):
                    c.append(v)
            n, rep = np.array(cols[0], np.int64), np.array(cols[4], np.int64)
            failed = (n < MIN_WORDS) | (100 * rep > int(100 * MAX_REPEAT_SHARE) * n)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.float64()), pa.array(failed)],
                ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed"],
            )

    return measured


def measure(text: bytes, words: Words, ratio: np.ndarray) -> tuple[int, int, int, int, int, float]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score of a whole text in UTF-8."""
    parts = text.split()  # at [\x20\x09-\x0D]
    n = len(parts)
    if not n:
        return 0, 0, 0, 0, 0, 0.0
    solid = text.translate(None, SPACE)
    # bytes that continue a code point don't count
    chars = len(solid) if solid.isascii() else len(solid.decode("utf-8"))
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    numbers = words.numbers(parts)
    return n, chars, len(solid) - len(solid.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(numbers), float(ratio[words.buckets(numbers)].mean())


def repeated_words(numbers: np.ndarray) -> int:
    """Words that lie in a window of 3 words found twice or more."""
    if len(numbers) < 4:
        return 0
    if numbers.max() >= 1 << 21:
        numbers = np.unique(numbers, return_inverse=True)[1]
    windows = (numbers[:-2] << 42) | (numbers[1:-1] << 21) | numbers[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(numbers), bool)
    hit = np.zeros(len(windows), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    for k in range(3):
        twice[k : k + len(windows)] |= hit
    return int(twice.sum())


def _fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[np.ndarray, float]:
    """The model and its threshold."""
    ratio, good, bad = ngram_model(docs, labels, id_col=id_col, text_col=text_col)
    held = good + bad
    rows, schema = _rows(docs, id_col, text_col)
    # of rows that share an id the least score counts, in whatever order tasks end
    scored = rows.where(F.col("id").isin(held)).mapInArrow(_scoring(ratio), schema).groupBy("id").agg(F.min("score").alias("score"))
    seen = {r.id: r.score for r in scored.collect()} if held else {}
    return ratio, threshold(np.array([seen[i] for i in good if i in seen]), np.array([seen[i] for i in bad if i in seen]))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    return to_python(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))), SCORED.format(id=docs.schema[id_col].dataType.simpleString())


def quality_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, the base measures, score, threshold, base_failed, kept."""
    ratio, cut = _fitted(docs, labels, id_col, text_col)
    rows, schema = _rows(docs, id_col, text_col)
    scored = rows.mapInArrow(_scoring(ratio), schema)
    return scored.withColumn("threshold", F.lit(cut)).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= cut)).withColumnRenamed("id", id_col)


def good_rows(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that quality_scores() keeps, with all their columns."""
    ratio, cut = _fitted(docs, labels, id_col, text_col)
    scoring = _scoring(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows), batch[text_col].cast(pa.string())], ["id", "text"])
            for told in scoring(iter([named])):
                keep = ~told["base_failed"].to_numpy(zero_copy_only=False) & (told["score"].to_numpy() >= cut)
                yield batch.filter(pa.array(keep))

    return to_python(docs).mapInArrow(run, docs.schema)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base measures, score and verdict."""
    return quality_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
