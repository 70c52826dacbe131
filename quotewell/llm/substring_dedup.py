"""Substring deduplication: every byte covered by a `length`-byte string that also starts elsewhere is removed.

A Burrows-Wheeler transform of the whole corpus fits no task. So texts are cut where repeats cannot reach, exactly:

1. Anchors. Of the K-byte strings inside each window of `length` bytes, the least hash is the window's anchor (the leftmost of equals).
   Equal windows have equal anchors at equal offsets. Consecutive windows with the same anchor make up its context, so that each window
   lies in one context, and only contexts whose anchors have equal hashes can share a window.
2. Contexts whose anchor's hash occurs once are done. Contexts that occur twice or more as a whole (128-bit digest) are removed
   as they are: copies of documents cost a row an anchor and no bytes.
3. One representative of each other context, or of those that share an anchor with different contexts, goes to a bin by its anchor's
   hash. There the contexts' Burrows-Wheeler transform is extended breadth-first up to `length` (see bwt.py): what gets no common prefix
   below it is repeated, if it starts at two places.
4. An anchor with more than HOT_CONTEXTS different contexts would overfill a bin: its contexts' windows are compared by
   digest over all tasks instead.

Marks are joined back to the texts. Nothing is broadcast or collected but one count of anchors.

A passage of many short words may have fewer than `length` bytes. It is not removed, but told: n_shared counts a document's shingles of
PASSAGE_SHINGLE words that another document has, too, of those that are least by hash among PASSAGE_WINDOW neighbours. Every passage of
PASSAGE_SHINGLE + PASSAGE_WINDOW - 1 = 51 words that two documents have gives both one such shingle at least; shorter ones of
PASSAGE_SHINGLE words may. Such a shingle is a row of 16 bytes for each of its documents, read in one pass and never gathered.

Cases: a null text counts as empty. Texts shorter than length are never removed, nor are matches across documents or at the same place.
Texts of any length are read whole; a very long one is hashed in stretches that overlap.
Rows equal in id and text repeat each other. Overlapping repeats of one text count (runs of a letter go). Empty tables give
empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_intdigest

from .bwt import long_prefixes
from .common import load, materialise, text_or_empty, to_python

LENGTH, K = 400, 32
#: Bytes of a text hashed at once; windows of the next stretch overlap.
STRETCH = 1 << 18
#: Bytes of contexts in a bin, about.
BIN_BYTES = 1_000_000
HOT_CONTEXTS = 2_000
#: Words; any 51 in a row are PASSAGE_WINDOW shingles, of which the least is told.
PASSAGE_SHINGLE, PASSAGE_WINDOW = 26, 26
#: Distinct words that a task remembers between documents, a cache.
REMEMBERED = 1 << 16

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if 0 not in _POWERS or len(_POWERS[0][0]) < n:
        size = max(n, 1 << 14)
        up, down = (np.full(size, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
        up[0] = down[0] = 1
        _POWERS[0] = np.cumprod(up), np.cumprod(down)
    up, down = _POWERS[0]
    return up[:n], down[:n]


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    span = 1
    while 2 * span <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = w - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(text: bytes, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, first, last): the anchors of all windows of length bytes, each with the run of window starts that it has."""
    n, at, out = len(text), 0, []
    data = np.frombuffer(text, np.uint8)
    while at + length <= n:
        part = data[at : at + STRETCH + length - 1]
        up, down = _powers(len(part) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)])
        h = (sums[k:] - sums[:-k]) * down[: len(sums) - k]
        h ^= h >> np.uint64(32)
        h *= _MIX
        h ^= h >> np.uint64(29)
        # the hash's upper bits, then the place: of equal hashes the leftmost is least
        ranked = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        best = _window_min(ranked, length - k + 1)
        where = (best & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        last = np.append(first[1:], len(where)) - 1
        out.append((where[first] + at, h[where[first]], first + at, last + at))
        at += STRETCH
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _halves(digests: list[int]) -> tuple[pa.Array, pa.Array]:
    low = (1 << 64) - 1
    return pa.array([_signed(d >> 64) for d in digests], pa.int64()), pa.array([_signed(d & low) for d in digests], pa.int64())


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    for i, x in enumerate(batch["text"]):
        yield i, x.as_buffer().to_pybytes()


def _anchor_rows(length: int, k: int):
    """h, c1, c2 (digest of the context and its anchor's place in it), d1, d2 (the row), lo, hi (the context)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, cols, digests = [np.zeros(0, np.int64)], [anchors(b"", length, k)], []
            for i, text in _texts(batch):
                got = anchors(text, length, k)
                owner.append(np.full(len(got[0]), i))
                cols.append(got)
                digests += [xxh3_128_intdigest(text[a : z + length], p - a) for p, a, z in zip(got[0].tolist(), got[2].tolist(), got[3].tolist(), strict=True)]
            at = pa.array(np.concatenate(owner))
            _, h, lo, last = (np.concatenate(x) for x in zip(*cols, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), *_halves(digests), batch["d1"].take(at), batch["d2"].take(at), pa.array(lo.astype(np.int32)), pa.array((last + length).astype(np.int32))],
                ["h", "c1", "c2", "d1", "d2", "lo", "hi"],
            )

    return run


def _contexts(bins: int):
    """Rows with text and marks (h, lo, hi, hot) -> hot, bin, d1, d2, lo, body: the contexts' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[] for _ in range(6)]
            d1, d2 = batch["d1"].to_pylist(), batch["d2"].to_pylist()
            for i, text in _texts(batch):
                for m in batch["marks"][i].as_py():
                    for c, v in zip(out, (m["hot"], m["h"] % bins, d1[i], d2[i], m["lo"], text[m["lo"] : m["hi"]]), strict=True):
                        c.append(v)
            kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["hot", "bin", "d1", "d2", "lo", "body"])

    return run


def repeated_in_bin(d1: np.ndarray, d2: np.ndarray, lo: np.ndarray, bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop): runs of starts, in places of the document, of strings of length bytes that start at two or more places."""
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    symbols = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8).astype(np.int16) + 1
    stops = np.cumsum(sizes)
    symbols[stops - 1] = 0
    sa, ends = long_prefixes(symbols, length)
    row = np.repeat(np.arange(len(bodies)), sizes)
    inside = np.arange(len(symbols)) - np.repeat(stops - sizes, sizes)
    whole = sizes[row] - 1 - inside >= length
    document = np.unique(np.stack([d1, d2]), axis=1, return_inverse=True)[1].ravel()
    place = (document[row] << 32) + inside + lo[row]
    group = np.cumsum(ends[:-1])
    keep = whole[sa]
    sa, group = sa[keep], group[keep]
    marked = np.zeros(len(symbols) + 1, bool)
    if len(sa):
        at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        differs = np.minimum.reduceat(place[sa], at) != np.maximum.reduceat(place[sa], at)
        marked[sa[np.repeat(differs, np.diff(np.append(at, len(sa))))]] = True
    # a separator follows each context, so runs end with it
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8)]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return row[begin], (inside[begin] + lo[row[begin]]).astype(np.int32), (inside[begin] + lo[row[begin]] + end - begin - 1 + length).astype(np.int32)


def _bin_runs(length: int):
    def run(table: pa.Table) -> pa.Table:
        d1, d2, lo = (table[c].to_numpy() for c in ("d1", "d2", "lo"))
        row, start, stop = repeated_in_bin(d1, d2, lo.astype(np.int64), table["body"].to_pylist(), length)
        return pa.table({"d1": d1[row], "d2": d2[row], "start": pa.array(start), "stop": pa.array(stop)})

    return run


def _windows(length: int):
    """w1, w2 (digest), d1, d2, start of every window of each context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = batch["lo"].to_pylist()
            for i, body in enumerate(batch["body"].to_pylist()):
                n = len(body) - length + 1
                digests = [xxh3_128_intdigest(body[a : a + length]) for a in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [*_halves(digests), *(pa.array([batch[c][i].as_py()] * n, pa.int64()) for c in ("d1", "d2")), pa.array(np.arange(lo[i], lo[i] + n, dtype=np.int32))], ["w1", "w2", "d1", "d2", "start"]
                )

    return run


def least_shingles(hashes: np.ndarray, shingle: int, window: int) -> np.ndarray:
    """Of a text's word hashes: the hashes of shingles that are least among `window` neighbours, once each."""
    if len(hashes) < shingle + window - 1:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(hashes) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)])
    h = (sums[shingle:] - sums[:-shingle]) * down[: len(sums) - shingle]
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return np.unique(_window_min(h ^ (h >> np.uint64(29)), window))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """h, d1: the told shingles of every text."""
    known: dict[bytes, int] = {}
    for batch in batches:
        found, owner, d1 = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], batch["d1"].to_numpy()
        for i, text in _texts(batch):
            words = text.split()
            if len(known) > REMEMBERED:
                known = {}
            for w in set(words).difference(known):
                known[w] = xxh3_64_intdigest(w)
            found.append(least_shingles(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), PASSAGE_SHINGLE, PASSAGE_WINDOW))
            owner.append(np.full(len(found[-1]), d1[i]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(owner))], ["h", "d1"])


def _shared_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by h and d1: d1 of those whose h another document has, too. Nothing of a hash is kept but its first document."""
    last_h = last_d = None
    told = False  # of the last row
    for batch in batches:
        h, d1 = batch["h"].to_numpy(), batch["d1"].to_numpy()
        if not len(h):
            continue
        before_h, before_d = np.concatenate([h[:1], h[:-1]]), np.concatenate([d1[:1], d1[:-1]])
        if last_h is not None:
            before_h[0], before_d[0] = last_h, last_d
        same = before_h == h
        if last_h is None:
            same[0] = False
        differs = same & (before_d != d1)
        group = np.cumsum(~same)
        mixed = np.zeros(group[-1] + 1, bool)  # group 0 goes on from the batch before
        mixed[0] = told
        mixed[group[differs]] = True
        out = d1[mixed[group] & ~(same & ~differs)]  # a row that repeats the one before it is told already
        if same[0] and mixed[group[0]] and not told:  # the first documents, in a batch before, are all one
            out = np.append(out, last_d)
        last_h, last_d, told = h[-1], d1[-1], bool(mixed[group[-1]])
        yield pa.RecordBatch.from_arrays([pa.array(out)], ["d1"])


def shared_shingles(rows: DataFrame) -> DataFrame:
    """rows (d1, text) -> d1, n_shared, for documents that have any. Rows with one d1 are one document."""
    told = rows.select("d1", "text").mapInArrow(_shingle_rows, "h long, d1 long")
    met = told.repartition("h").sortWithinPartitions("h", "d1").mapInArrow(_shared_shingles, "d1 long")
    return met.groupBy("d1").agg(F.count("*").alias("n_shared"))


def _cut() -> Callable:
    """Rows with text and runs -> spans and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept, d2 = [], [], batch["d2"].to_pylist()
            for i, text in _texts(batch):
                spans.append(merged([(r["start"], r["stop"]) for r in batch["runs"][i].as_py() or () if r["d2"] == d2[i]]))
                kept.append(without(text, spans[-1]))
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            told = pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], kind)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array([x.as_buffer().size for x in batch["text"]], pa.int64()), told, pa.array(kept, pa.binary()), batch["n_shared"]], ["id", "n_bytes", "spans", "kept", "n_shared"])

    return run


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs: those that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def substring_dedup(docs: DataFrame, *, length: int = LENGTH, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, spans (start, stop of the removed runs, in bytes), kept (binary: the remaining bytes), n_shared."""
    if not 2 * k <= length < STRETCH:
        raise ValueError("length must be at least 2 k, and less than STRETCH")
    text = text_or_empty(text_col)
    named = to_python(docs).select(F.col(id_col).alias("id"), text.alias("text"))
    rows = named.select("id", "text", F.xxhash64("id", "text").alias("d1"), F.xxhash64(F.lit(1), "text", "id").alias("d2"))
    found = rows.where(F.octet_length("text") >= length).select("d1", "d2", "text").mapInArrow(_anchor_rows(length, k), "h long, c1 long, c2 long, d1 long, d2 long, lo int, hi int")
    found = materialise(found, "anchors")
    # sides of joins are written first: then the adaptive join may split a hash that very many texts share
    shared = materialise(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "shared")
    found = materialise(found.join(shared, "h"), "shared-anchors")
    place = F.struct("d1", "d2", "lo")
    by_context = found.groupBy("h", "c1", "c2").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    by_context = materialise(by_context, "contexts")
    different = materialise(by_context.groupBy("h").agg(F.count("*").alias("contexts")), "different")
    told = materialise(by_context.join(different, "h").where("n > 1 OR contexts > 1").select("h", "c1", "c2", "n", "first", "contexts"), "told")
    marks = found.join(told, ["h", "c1", "c2"]).select(
        "d1", "d2", "lo", "hi", "h", (F.col("n") > 1).alias("whole"), (F.col("contexts") > HOT_CONTEXTS).alias("hot"), ((F.col("contexts") > 1) & (F.col("first") == place)).alias("open")
    )
    marks = materialise(marks.distinct(), "marks")  # rows equal in id and text share their marks
    bins = max(1, int(marks.where("open AND NOT hot").agg(F.sum(F.col("hi") - F.col("lo"))).first()[0] or 0) // BIN_BYTES)
    asked = marks.where("open").groupBy("d1", "d2").agg(F.collect_list(F.struct("h", "lo", "hi", "hot")).alias("marks"))
    once = rows.select("d1", "d2", "text").join(asked, ["d1", "d2"])
    # of rows equal in id and text, each brings the same contexts; a place is one place however often it comes
    contexts = materialise(once.mapInArrow(_contexts(bins), "hot boolean, bin long, d1 long, d2 long, lo int, body binary"), "bodies")
    runs = contexts.where("NOT hot").select("bin", "d1", "d2", "lo", "body").groupBy("bin").applyInArrow(_bin_runs(length), "d1 long, d2 long, start int, stop int")
    windows = contexts.where("hot").select("d1", "d2", "lo", "body").mapInArrow(_windows(length), "w1 long, w2 long, d1 long, d2 long, start int")
    start = F.struct("d1", "d2", "start")
    twice = windows.groupBy("w1", "w2").agg(F.min(start).alias("a"), F.max(start).alias("b")).where("a <> b").select("w1", "w2")
    hot_runs = windows.join(twice, ["w1", "w2"]).select("d1", "d2", "start", (F.col("start") + length).cast("int").alias("stop"))
    whole = marks.where("whole").select("d1", "d2", F.col("lo").alias("start"), F.col("hi").alias("stop"))
    runs = runs.unionByName(hot_runs).unionByName(whole).groupBy("d1").agg(F.collect_set(F.struct("d2", "start", "stop")).alias("runs"))
    passages = shared_shingles(rows)
    verdicts = runs.join(passages, "d1", "full")
    kind = docs.schema[id_col].dataType.simpleString()
    cut = rows.join(verdicts, "d1", "left").select("id", "d2", "text", "runs", F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"))
    cut = cut.mapInArrow(_cut(), f"id {kind}, n_bytes long, spans array<struct<start:int,stop:int>>, kept binary, n_shared long")
    return cut.withColumnRenamed("id", id_col)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents without the bytes of 400-byte strings that start elsewhere, too; n_shared tells passages of over 50 words, however few bytes they have."""
    out = substring_dedup(load(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s.stop - s.start))
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "n_shared", (F.col("n_shared") > 0).alias("has_passage"))
