"""Groups of near copies: fingerprints that are near, and every pair of texts whose word shingles have a Jaccard similarity of least or more.

Links of near fingerprints (see simhash) come first and join most of a group. What they leave apart is looked for by MinHash: the set of
a text's shingles has HASHES minima, dealt to BANDS bands, and two sets meet in a bucket if all minima of a band agree. At a similarity of 0.8
two sets miss each other in all bands with a chance of 4e-4, above it with less; at 0.3, as texts with a common frame have, they meet with one of 0.05. Only buckets that hold parts
of different groups are looked into. First a sketch of a byte a minimum tells which sets may have a similar one in their bucket: two at a similarity of 0.8 agree in 80 of 100 minima, give or
take 4, and are passed over if they agree in less than 55 (a chance of 4e-9, where the bands alone miss 4e-4); nearly all strangers are. Of those left the sets come along, similarities
are exact, and a spanning forest of the links leaves the task, never all pairs. So what is shuffled grows with the documents, and not with the buckets that strangers share.
Sets that meet in several buckets are compared in the first one. A bucket of more than BLOCK sets is dealt out to blocks, and each pair of blocks is a task's work of its own: no task holds more than two blocks, and no pair is left out.

Cases: texts without words have no shingles and meet by their fingerprint alone; texts shorter than a shingle are one shingle; very long texts are read whole.
Null ids, repeated rows and empty tables need no rule: rows are known by a digest of id and text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, row_key, text_or_empty, to_python
from .components import components
from .simhash import _node, _unite, near_links, pair_of, shingle_hashes

BANDS, ROWS = 20, 5
HASHES = BANDS * ROWS
#: Odd multipliers, one for each minimum.
_BY = np.random.default_rng(42).integers(1, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Shingles whose minima are taken at once.
AT_ONCE = 1 << 12
#: Sets of a bucket that are compared together.
BLOCK = 1_024


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    return _set_of(list(shingle_hashes(text, shingle)))


def _set_of(hashes: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(hashes).astype(np.uint64)) if hashes else np.zeros(0, np.uint64)


def minima_of(own: np.ndarray) -> np.ndarray:
    """HASHES minima of a set that isn't empty."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), AT_ONCE):
        x = own[at : at + AT_ONCE, None] * _BY
        x ^= x >> np.uint64(32)
        x *= _MIX
        np.minimum(least, x.min(0), out=least)
    return least


def bands_of(own: np.ndarray) -> np.ndarray:
    """A key for each band of a set that isn't empty."""
    return _keys(minima_of(own))


def sketch_of(minima: np.ndarray) -> bytes:
    """A byte a minimum, the same for equal ones and for one in 256 of the others, and four of each band's key, as the bytes of its minima are too few to tell whether it is shared."""
    return minima.astype(np.uint8).tobytes() + _keys(minima).astype(np.uint32).tobytes()


def _keys(minima: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for m in minima.reshape(BANDS, ROWS).T:
        key = (key ^ m) * _MIX
        key ^= key >> np.uint64(32)
    return key


def _prints(rows: DataFrame, shingle: int) -> DataFrame:
    """key, text -> key, fp, fp2, bands and sketch (null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, bands, sketches = [], [], []
            for x in batch["text"]:
                hashes = list(shingle_hashes(x.as_buffer().to_pybytes(), shingle))
                pairs.append(pair_of(hashes, True))
                minima = minima_of(_set_of(hashes)) if hashes else None
                bands.append(None if minima is None else _keys(minima).view(np.int64))
                sketches.append(None if minima is None else sketch_of(minima))
            got = np.array(pairs, np.uint64).reshape(-1, 2)
            cols = [pa.array(np.ascontiguousarray(got[:, k]).view(np.int64)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch["key"], *cols, pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], ["key", "fp", "fp2", "bands", "sketch"])

    return to_python(rows).select("key", "text").mapInArrow(run, "key binary, fp long, fp2 long, bands array<long>, sketch binary")


def enough_minima(least: float) -> int:
    """Minima in which two sets agree at a similarity of least: the mean less 6.25 times its deviation."""
    return max(ROWS, int(HASHES * least - 6.25 * (HASHES * least * (1 - least)) ** 0.5))


def _promising(least: float):
    """Over rows sorted by band: those of sets that may be similar to one of another group in their bucket, by their sketches. at: the band's number; two sets count in the first band that they share."""
    enough = enough_minima(least)

    def told(at: int, roots: list[str], sketches: list[bytes]) -> list[int]:
        group = np.unique(np.array(roots), return_inverse=True)[1]
        sketch = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(roots), HASHES + 4 * BANDS)
        own, bands = sketch[:, :HASHES], np.ascontiguousarray(sketch[:, HASHES:]).view(np.uint32)
        kept = np.zeros(len(roots), bool)
        for i in range(len(roots) - 1):
            others = i + 1 + np.flatnonzero((group[i + 1 :] != group[i]) & ~(kept[i] & kept[i + 1 :]))
            near = others[(own[others] == own[i]).sum(1) >= enough]
            near = near[(bands[near] == bands[i]).argmax(1) == at]
            kept[near] = True
            kept[i] |= len(near) > 0
        return np.flatnonzero(kept).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(band: tuple[int, int] | None, keys: list[bytes], roots: list[str], sketches: list[bytes]) -> Iterator[pa.RecordBatch]:
            if len(keys) > 1 and (kept := told(band[1], roots, sketches)):
                cols = [pa.array([keys[i] for i in kept], pa.binary()), pa.array([roots[i] for i in kept], pa.string()), pa.array([band[0]] * len(kept), pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["key", "root", "band"])

        now, keys, roots, sketches = None, [], [], []
        for batch in batches:
            for band, at, key, root, sketch in zip(*(batch[x].to_pylist() for x in ("band", "at", "key", "root", "sketch")), strict=True):
                if (band, at) != now:
                    yield from out(now, keys, roots, sketches)
                    now, keys, roots, sketches = (band, at), [], [], []
                keys.append(key)
                roots.append(root)
                sketches.append(sketch)
        yield from out(now, keys, roots, sketches)

    return run


def _similar(least: float):
    """Over rows sorted by band: compare the sets of different groups in a bucket; emit a spanning forest of the groups' links."""

    def links(roots: list[str], sets: list[bytes]) -> list[tuple[str, str]]:
        names, group = np.unique(np.array(roots), return_inverse=True)
        if len(names) < 2:
            return []
        order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
        own, group = [np.frombuffer(sets[i], np.uint64) for i in order], group[order]
        size = np.array([len(x) for x in own])
        ids = np.unique(np.concatenate(own), return_inverse=True)[1].ravel()
        ends = np.cumsum(size)
        starts = ends - size
        # similar sets are of similar sizes: with a set meet only those after it, up to so many times its size
        until = np.searchsorted(size, size / least + 1e-9, "right")
        root, found, mark = np.arange(len(names)), [], np.zeros(ids.max() + 1, bool)
        for i in range(len(own) - 1):
            others = slice(i + 1, until[i])
            if until[i] <= i + 1 or (root[group[others]] == root[group[i]]).all():
                continue
            mine = ids[starts[i] : ends[i]]
            mark[mine] = True
            both = np.add.reduceat(mark[ids[ends[i] : ends[until[i] - 1]]], starts[others] - ends[i], dtype=np.int64)
            mark[mine] = False
            ok = np.flatnonzero((both >= least * (size[others] + size[i] - both) - 1e-9) & (root[group[others]] != root[group[i]]))
            for g in np.unique(group[others][ok]).tolist():
                if root[g] != root[group[i]]:
                    found.append((str(names[group[i]]), str(names[g])))
                    _unite(root, np.array([group[i]]), np.array([g]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(found: list[tuple[str, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], ["a", "b"])

        now, roots, sets = None, [], []
        for batch in batches:
            for band, root, own in zip(batch["band"].to_pylist(), batch["root"].to_pylist(), batch["own"].to_pylist(), strict=True):
                if band != now:
                    if found := links(roots, sets):
                        yield told(found)
                    now, roots, sets = band, [], []
                roots.append(root)
                sets.append(own)
        if found := links(roots, sets):
            yield told(found)

    return run


def similar_links(rows: DataFrame, placed: DataFrame, *, shingle: int, least: float) -> DataFrame:
    """rows (key, text), placed (key, root, bands, sketch) -> links (a, b) of roots that have texts with a similarity of least or more."""
    spread = placed.select("key", "root", F.posexplode("bands").alias("at", "band"))
    mark = F.xxhash64("root")
    buckets = spread.groupBy("band").agg(F.min(mark).alias("lo"), F.max(mark).alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    shared = buckets.select("band", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    shared = materialise(shared, "shared-bands")  # written first, so that the adaptive join may split a common band
    mine = F.pmod(F.xxhash64("key", F.lit(7)), F.col("blocks"))
    cells = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.when(F.col("blocks") == 1, F.col("band")).otherwise(F.xxhash64("band", F.least(mine, k), F.greatest(mine, k))))
    met = spread.join(shared, "band").select("key", "root", "at", F.explode(cells).alias("band")).distinct()
    sketched = met.join(placed.select("key", "sketch").dropDuplicates(["key"]), "key").repartition("band").sortWithinPartitions("band", "at").select("band", "at", "key", "root", "sketch")
    met = materialise(sketched.mapInArrow(_promising(least), "key binary, root string, band long"), "met")
    wanted = materialise(met.select("key").distinct(), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingle_set(x.as_buffer().to_pybytes(), shingle).tobytes() for x in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(own, pa.binary())], ["key", "own"])

    texts = rows.join(wanted, "key", "left_semi").dropDuplicates(["key"]).select("key", "text")
    own = materialise(to_python(texts).mapInArrow(sets, "key binary, own binary"), "sets")
    buckets = met.join(own, "key").select("band", "root", "own")
    return buckets.repartition("band").sortWithinPartitions("band").mapInArrow(_similar(least), "a string, b string").distinct()


def near_groups(docs: DataFrame, *, shingle: int, max_bits: int, second_bits: int, least: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: key (of id and text, see row_key), component (a name). Links are near fingerprints and similar texts."""
    t = text_or_empty(text_col)
    rows = docs.select(row_key(F.col(id_col), t).alias("key"), t.alias("text"))
    prints = materialise(_prints(rows, shingle).withColumn("mine", _node("fp", "fp2", True)), "prints")
    near = components(near_links(prints.select("fp", "fp2").distinct(), max_bits=max_bits, second_bits=second_bits))
    near = near.select(F.col("node").alias("mine"), F.col("root").alias("near"))
    placed = materialise(prints.join(near, "mine", "left").select("key", F.coalesce("near", "mine").alias("root"), "bands", "sketch"), "placed")
    wider = components(similar_links(rows, placed, shingle=shingle, least=least)).select(F.col("node").alias("root"), F.col("root").alias("wide"))
    return placed.join(wider, "root", "left").select("key", F.coalesce("wide", "root").alias("component"))
