"""Periodic runs of words by bit-parallel lags over big integers.

The words of many texts are numbered and laid end to end, with a number of its own between two texts, so that no stretch goes from one to the next. Bit k of
all numbers makes bit plane k, one big integer. At a lag q, XOR of each plane with itself shifted by q, OR-ed over the planes, marks the places whose word
differs from that q words on. Of its complement, AND with shifted copies, doubling the shift, leaves the places at which a stretch of at least
max(LEAST, TIMES * q) - q matches begins: these are the runs with period q. A run that a smaller lag has found already has that smaller period
(with TIMES >= 2 periods, two periods of one stretch have their divisor as a period, too), so lags go upwards and a stretch counts once.

Before that, a lag is passed over if it can have no run: a stretch of m matches holds one of every m places, and three matches in a row at it. Only those are
looked at, in N log N steps for all lags together, so a text of a million words doesn't cost its square.

Cases: null and empty texts have no words and no runs; a text of any length is one piece of a batch, never cut. A null id is not rewritten by planted().
Equal rows give equal results, row by row; empty tables give none. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, to_python

#: Words are what stands between blanks and ASCII control spaces.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A run has at least LEAST words and at least TIMES periods.
LEAST, TIMES = 6, 4
#: Words of several texts that share the planes, unless one text has more.
WORDS_AT_ONCE = 60_000

Run = tuple[int, int, int]


def _plane(bits: np.ndarray) -> int:
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def _places(bits: int, size: int) -> np.ndarray:
    return np.nonzero(np.unpackbits(np.frombuffer(bits.to_bytes(size // 8 + 1, "little"), np.uint8), bitorder="little"))[0]


def _lags(ids: np.ndarray, longest: int) -> Iterator[tuple[int, int]]:
    """(q, matches wanted in a row) of the lags at which a run is possible."""
    base = int(ids.max(initial=0)) + 1
    three = (ids[:-2] * base + ids[1:-1]) * base + ids[2:] if base < 1 << 20 else np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0, return_inverse=True)[1].ravel()
    for q in range(1, longest // TIMES + 1):
        wanted = max(LEAST, TIMES * q) - q
        for first in range(3):
            later = three[first + q :: wanted]
            if (three[first::wanted][: len(later)] == later).any():
                yield q, wanted
                break


def find_runs(texts: list[list[str]]) -> list[list[Run]]:
    """(start, length, period) of all runs of each list of words, by start, then period."""
    number: dict[str, int] = {}
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    ids = np.empty(int(starts[-1]), np.int64)
    for text, at in zip(texts, starts.tolist()):
        ids[at : at + len(text)] = [number.setdefault(w, len(number)) for w in text]
    ids[starts[1:] - 1] = np.arange(len(number), len(number) + len(texts))
    size = len(ids)
    planes = [_plane((ids >> k) & 1) for k in range(int(ids.max(initial=0)).bit_length())]
    found: dict[tuple[int, int], int] = {}
    for q, wanted in _lags(ids, int(lengths.max(initial=0))) if size > LEAST else ():
        differ = 0
        for plane in planes:
            differ |= plane ^ (plane >> q)
        left = ~differ & ((1 << size - q) - 1)
        have = 1
        while left and have < wanted:
            step = min(have, wanted - have)
            left &= left >> step
            have += step
        if left:
            for s, e in zip(_places(left & ~(left << 1), size).tolist(), _places(left & ~(left >> 1), size).tolist(), strict=True):
                found.setdefault((s, e + wanted + q), q)
    out: list[list[Run]] = [[] for _ in texts]
    owner = np.searchsorted(starts, [s for s, _ in found], side="right") - 1
    for k, ((s, e), q) in zip(owner.tolist(), found.items(), strict=True):
        out[k].append((s - int(starts[k]), e - s, q))
    for own in out:
        own.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[str], runs: list[Run]) -> list[str]:
    """The words without those that a run repeats: of each run its first period stays, unless another run drops it."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(gone).tolist()) if not n]


def planted(row_id: object, words: list[str]) -> list[str]:
    """A fixed tenth of rows, by the checksum of their id, repeat a part of themselves to their end."""
    h = zlib.crc32(str(row_id).encode())
    if row_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def _batches(lengths: list[int]) -> Iterator[list[int]]:
    """Places of texts that share planes: lengths alike, as the longest sets the number of lags."""
    some: list[int] = []
    size = 0
    for k in sorted(range(len(lengths)), key=lengths.__getitem__):
        if some and size + lengths[k] > WORDS_AT_ONCE:
            yield some
            some, size = [], 0
        some.append(k)
        size += lengths[k] + 1
    if some:
        yield some


def _over_texts(docs: DataFrame, schema: str, make: Callable[[list, list[list[str]], list[list[Run]]], pa.RecordBatch], id_col: str, text_col: str, rewrite: Callable[[object, list[str]], list[str]] | None) -> DataFrame:
    """make(ids, words, runs) for the rows of each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["id"].to_pylist()
            words = [WORD.findall(t or "") for t in batch["text"].to_pylist()]
            if rewrite:
                words = [rewrite(i, w) for i, w in zip(ids, words, strict=True)]
            runs: list[list[Run]] = [[]] * len(words)
            for some in _batches([len(w) for w in words]):
                for k, own in zip(some, find_runs([words[k] for k in some]), strict=True):
                    runs[k] = own
            yield make(batch["id"], words, runs)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = to_python(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
    return rows.mapInArrow(run, f"id {kind}, {schema}").withColumnRenamed("id", id_col)


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, runs array<struct<start, length, period>>, collapsed (the text's words without repeats, joined by one blank) of every whole text."""

    def make(ids: pa.Array, words: list, runs: list) -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        told = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
        return pa.RecordBatch.from_arrays([ids, pa.array(told, kind), pa.array([" ".join(collapse(w, r)) for w, r in zip(words, runs, strict=True)])], ["id", "runs", "collapsed"])

    return _over_texts(docs, "runs array<struct<start: long, length: long, period: long>>, collapsed string", make, id_col, text_col, None)


def strongest(runs: list[Run]) -> Run | None:
    """The run with most periods; ties go to the smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def run_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable[[object, list[str]], list[str]] | None = None) -> DataFrame:
    """id_col, n_runs; start, length, period, exponent_milli of the strongest run; runs_sha256, collapsed_sha256."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def make(ids: pa.Array, words: list, runs: list) -> pa.RecordBatch:
        best = [strongest(own) for own in runs]
        columns = [pa.array([b and b[k] for b in best], pa.int64()) for k in range(3)]
        milli = pa.array([b and 1000 * b[1] // b[2] for b in best], pa.int64())
        said = pa.array([sha("".join(f"{s},{n},{p}\n" for s, n, p in own)) for own in runs], pa.string())
        left = pa.array([sha(" ".join(collapse(w, r))) for w, r in zip(words, runs, strict=True)], pa.string())
        return pa.RecordBatch.from_arrays([ids, pa.array([len(r) for r in runs], pa.int64()), *columns, milli, said, left], ["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    schema = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _over_texts(docs, schema, make, id_col, text_col, rewrite)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text of documents, a tenth of which repeats a part of itself."""
    return run_digests(load(spark, sf_dir, "documents"), rewrite=planted)
