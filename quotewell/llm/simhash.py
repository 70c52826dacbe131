"""SimHash near-deduplication by the generalised pigeonhole principle.

A document's fingerprint has 64 bits; a bit is set if it is in more than half of the XXH64 of its word shingles, repeats included.
To find all pairs of fingerprints that differ in at most max_bits bits, the bits are dealt out to m parts. If thresholds t_i of the parts
sum to max_bits - m + 1, two such fingerprints differ in at most t_i bits of some part i (t_i = -1: the part is skipped).

* Bits that are correlated over the corpus go to the same part, so that different parts tell different things.
* Each fingerprint gets thresholds of its own: dynamic programming takes those with the least estimated candidates plus
  probes, from exact histograms of the parts' blocks. Parts whose value is common get low thresholds.
* Every fingerprint is stored under its parts' values and probes all values within its thresholds. Candidates are compared in
  full, in numpy, and only a spanning forest of the links found in a task leaves it: never all pairs of a group.
* A value that, by the histograms, more than HOT_VALUE fingerprints may share is cut into slices by a hash of the whole fingerprint: each is stored in
  one slice and probes all, so that no task holds a common value's fingerprints together.

With second_bits, each document has a second fingerprint of other hashes, and a link needs that one to be near as well: at a loose max_bits
64 bits alone would link strangers in a large corpus. Equal fingerprints are one node from the start. What reaches the driver is bounded: 64 x 64 bit counts and the blocks' histograms.

Cases: a null or empty text has no words and fingerprint zero, linked like any other; texts shorter than a shingle are one shingle, and very long ones are read whole. Null ids are
linked but never name a component unless all are null. Repeated rows come out as often as they come in. Empty tables give empty results;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import load, materialise, to_python
from .components import components

SEED, BITS = 42, 64
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Shingles whose bits are added up at once.
AT_ONCE = 1 << 15
#: Pairs compared at once.
PAIRS = 1 << 21
#: A probe, which is made, shuffled and sorted, costs as much as comparing so many candidates in numpy.
PROBE_COST = 64.0
BLOCK_BITS = 16
#: Fingerprints of one part value that a task compares with what probes them.
HOT_VALUE = 20_000


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint proper."""
    return fingerprint_pair(text, shingle, False)[0]


def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle in order, repeats included. Words are what bytes.split() gives: runs of other than [\\x20\\x09-\\x0D]; bytes.lower() changes A-Z alone."""
    words = text.lower().split()
    if not words:
        return
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.diff(ends, prepend=0))[:n].tolist()
    stops = (ends - 1)[-n:].tolist()
    for at in range(0, n, AT_ONCE):
        yield np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[at : at + AT_ONCE], stops[at : at + AT_ONCE], strict=True)), ">u8")


def fingerprint_pair(text: bytes, shingle: int, second: bool) -> tuple[int, int]:
    """The fingerprint and, if asked for, a second one, of the mixed hashes."""
    return pair_of(shingle_hashes(text, shingle), second)


def pair_of(hashes: Iterable[np.ndarray], second: bool) -> tuple[int, int]:
    """fingerprint_pair() of what shingle_hashes() gives."""
    n, ones = 0, np.zeros((2, BITS), np.int64)
    for h in hashes:
        n += len(h)
        ones[0] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        if second:
            m = h.astype(np.uint64)
            for _ in range(2):
                m = (m ^ (m >> np.uint64(32))) * _MIX
            ones[1] += _bits(m).sum(0, dtype=np.int64)
    one, two = (int.from_bytes(x.tobytes()) for x in np.packbits(2 * ones > n, axis=1))
    return one, two


def fingerprints(docs: DataFrame, *, shingle: int, second: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp, fp2 (64 bits each as a signed long; fp2 is 0 unless asked for) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint_pair(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle, second) for x in batch["text"]], np.uint64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(np.ascontiguousarray(got[:, k]).view(np.int64)) for k in (0, 1))], ["id", "fp", "fp2"])

    kind = docs.schema[id_col].dataType.simpleString()
    return to_python(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp long, fp2 long")


def _bits(fp: np.ndarray) -> np.ndarray:
    """n x 64, bit 63 first."""
    return np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _summed(nodes: DataFrame, cells: int, count) -> np.ndarray:
    """count(fp array) -> array of cells; added up over all nodes. cells bounds the rows a task makes and the driver gets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            total += count(batch["fp"].to_numpy().view(np.uint64))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["cell", "n"])

    got = nodes.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(cells, np.int64)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out


def group_bits(together: np.ndarray, n: int, widths: list[int]) -> list[list[int]]:
    """Deal bits out to parts of the given widths: a part starts with the most correlated pair left and takes in what correlates most with it."""
    p = np.diag(together) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    left, parts = list(range(BITS)), []
    for width in widths:
        sub = corr[np.ix_(left, left)]
        part = [left[int(np.argmax(sub.max(1)))]]
        left.remove(part[0])
        while len(part) < width:
            best = max(left, key=lambda b: (corr[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        parts.append(part)
    return parts


def widths_for(n: int, max_bits: int) -> list[int]:
    """Widths of the parts, for the least probes plus candidates if values were uniform. More rows: fewer, wider parts."""

    def widths(m: int) -> list[int]:
        return [BITS // m + (k < BITS % m) for k in range(m)]

    def cost(m: int) -> float:
        budget = max_bits - m + 1
        probes = [sum(comb(w, d) for d in range(budget // m + (k < budget % m) + 1)) for k, w in enumerate(widths(m))]
        return PROBE_COST * (sum(probes) + m) + n * sum(p / 2.0**w for p, w in zip(probes, widths(m), strict=True))

    return widths(min(range(1, max_bits + 2), key=cost))


class Plan:
    """Parts, their blocks of at most BLOCK_BITS bits, and how many fingerprints lie within 0, 1, 2 ... bits of each block's value."""

    def __init__(self, parts: list[list[int]], max_bits: int) -> None:
        self.parts, self.max_bits = parts, max_bits
        self.blocks = []
        for k, part in enumerate(parts):
            n = -(-len(part) // BLOCK_BITS)
            self.blocks += [(k, [int(b) for b in x]) for x in np.array_split(part, n)]
        self.offsets = np.cumsum([0, *(1 << len(b) for _, b in self.blocks)])
        self.masks = [[self._masks(len(p), d) for d in range(max_bits + 1)] if len(p) else [] for p in parts]

    @staticmethod
    def _masks(width: int, d: int) -> np.ndarray:
        return np.array([sum(1 << b for b in c) for c in combinations(range(width), d)], np.uint64) if comb(width, d) <= 200_000 else None

    @staticmethod
    def pick(bits: np.ndarray, chosen: list[int]) -> np.ndarray:
        out = np.zeros(len(bits), np.uint64)
        for b in chosen:
            out = (out << np.uint64(1)) | bits[:, b]
        return out

    def histogram(self, fp: np.ndarray) -> np.ndarray:
        bits, out = _bits(fp), np.zeros(self.offsets[-1], np.int64)
        for (_, chosen), at, stop in zip(self.blocks, self.offsets[:-1], self.offsets[1:], strict=True):
            out[at:stop] = np.bincount(self.pick(bits, chosen).astype(np.int64), minlength=stop - at)
        return out

    def learn(self, histogram: np.ndarray, n: int) -> None:
        """near[block][d][value]: the share of fingerprints that differ from value in d bits of the block."""
        self.n, self.near = n, []
        for (_, chosen), at, stop in zip(self.blocks, self.offsets[:-1], self.offsets[1:], strict=True):
            share = histogram[at:stop] / max(n, 1)
            # by dynamic programming over bits: within[d][v] sums the values that differ from v in d of the bits seen so far
            within = [share, *(np.zeros_like(share) for _ in range(self.max_bits))]
            v = np.arange(len(share))
            for b in range(len(chosen)):
                within = [within[d] + (within[d - 1][v ^ (1 << b)] if d else 0) for d in range(self.max_bits + 1)]
            self.near.append([x.astype(np.float32) for x in within])

    def slices(self, k: int, values: np.ndarray) -> np.ndarray:
        """Into how many slices each value of part k is cut: its blocks' histograms bound how many fingerprints have it."""
        most, at = np.full(len(values), np.inf), np.uint64(len(self.parts[k]))
        for (owner, chosen), near in zip(self.blocks, self.near, strict=True):
            if owner == k:  # blocks lie from the highest bits down
                at -= np.uint64(len(chosen))
                own = ((values >> at) & np.uint64((1 << len(chosen)) - 1)).astype(np.int64)
                most = np.minimum(most, self.n * near[0][own].astype(np.float64))
        return np.maximum(1, np.ceil(most / HOT_VALUE)).astype(np.int64)

    def thresholds(self, bits: np.ndarray) -> np.ndarray:
        """n x parts: the cheapest thresholds that sum to max_bits - parts + 1, each -1 or more."""
        m, n = len(self.parts), len(bits)
        cost = np.zeros((m, self.max_bits + 2, n))
        for k in range(m):
            exact = None
            for (owner, chosen), near in zip(self.blocks, self.near, strict=True):
                if owner == k:
                    v = self.pick(bits, chosen).astype(np.int64)
                    here = [x[v].astype(np.float64) for x in near]
                    exact = here if exact is None else [sum(exact[j] * here[d - j] for j in range(d + 1)) for d in range(self.max_bits + 1)]
            probes = found = 0.0
            for d in range(self.max_bits + 1):
                probes, found = probes + comb(len(self.parts[k]), d), found + exact[d]
                cost[k, d + 1] = self.n * found + PROBE_COST * probes if self.masks[k][d] is not None else np.inf
        goal = self.max_bits + 1  # in units of t + 1, which are 0 or more
        best = np.full((goal + 1, n), np.inf)
        best[0], took = 0.0, []
        for k in range(m):
            options = np.stack([np.stack([best[s - e] + cost[k, e] if s >= e else np.full(n, np.inf) for e in range(goal + 1)]) for s in range(goal + 1)])
            took.append(options.argmin(1))
            best = options.min(1)
        out, s = np.zeros((n, m), np.int64), np.full(n, goal)
        for k in reversed(range(m)):
            e = took[k][s, np.arange(n)]
            out[:, k], s = e - 1, s - e
        return out

    def signatures(self, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool, np.ndarray]]:
        """(key, slice, is a probe, which fingerprints, by place): where each is stored, and what it probes."""
        bits = _bits(fp)
        t = self.thresholds(bits)
        every, mixed = np.arange(len(fp)), (fp ^ (fp >> np.uint64(31))) * _MIX
        mixed ^= mixed >> np.uint64(32)
        for k, part in enumerate(self.parts):
            values = self.pick(bits, part)
            key = lambda v: (v << np.uint64(6)) | np.uint64(k) if len(self.parts) > 1 else v  # noqa: B023, E731
            yield key(values), (mixed % self.slices(k, values).astype(np.uint64)).astype(np.int64), False, every
            for d in range(self.max_bits + 1):
                own = np.flatnonzero(t[:, k] >= d)
                if len(own):
                    for mask in self.masks[k][d]:
                        probed = values[own] ^ mask
                        cut = self.slices(k, probed)
                        if cut.max() == 1:
                            yield key(probed), np.zeros(len(own), np.int64), True, own
                        else:
                            again = np.repeat(np.arange(len(own)), cut)
                            yield key(probed)[again], np.arange(len(again)) - np.repeat(np.cumsum(cut) - cut, cut), True, own[again]


def _linked(max_bits: int, second_bits: int | None):
    """Over rows sorted by key: compare probes with what is stored under their key; emit a spanning forest of a batch's links."""

    def links(key: np.ndarray, probe: np.ndarray, fp: np.ndarray, fp2: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((probe, key))
        key, probe, fp, fp2 = key[order], probe[order], fp[order], fp2[order]
        stored = ~probe
        n_stored = np.concatenate([[0], np.cumsum(stored)])
        asked = np.flatnonzero(probe)
        first, last = n_stored[np.searchsorted(key, key[asked], "left")], n_stored[np.searchsorted(key, key[asked], "right")]
        if second_bits is None:
            names, number = np.unique(fp, return_inverse=True)
            names2 = np.zeros_like(names)
        else:
            (names, names2), number = np.unique(np.stack([fp, fp2]), axis=1, return_inverse=True)
            number = number.ravel()
        held, root = number[stored], np.arange(len(names))
        count = last - first
        asked, first, count = asked[count > 0], first[count > 0], count[count > 0]
        at = 0
        while at < len(asked):
            upto = max(at + 1, int(np.searchsorted(np.cumsum(count[at:]), PAIRS, "right")) + at)
            for start in range(0, int(count[at]) if upto == at + 1 else 1, PAIRS):
                c = count[at:upto] if upto > at + 1 else np.minimum(count[at:upto] - start, PAIRS)
                row = np.repeat(np.arange(at, upto), c)
                other = held[np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c) + first[row] + start]
                own = number[asked[row]]
                differ = np.bitwise_count(names[own].view(np.uint64) ^ names[other].view(np.uint64))
                ok = np.flatnonzero((differ <= max_bits) & (own != other))
                own, other = own[ok], other[ok]
                if second_bits is not None:
                    ok = np.bitwise_count(names2[own].view(np.uint64) ^ names2[other].view(np.uint64)) <= second_bits
                    own, other = own[ok], other[ok]
                _unite(root, own, other)
            at = upto
        moved = np.flatnonzero(root != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (names[moved], names2[moved], names[root[moved]], names2[root[moved]])], ["a", "a2", "b", "b2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            got = [batch[c].to_numpy(zero_copy_only=False) for c in ("key", "probe", "fp", "fp2")]
            if rest is not None:
                got = [np.concatenate(x) for x in zip(rest, got, strict=True)]
            whole = int(np.searchsorted(got[0], got[0][-1], "left")) if len(got[0]) else 0  # the last key may go on
            if whole:
                yield links(*(x[:whole] for x in got))
            rest = [x[whole:] for x in got]
        if rest is not None and len(rest[0]):
            yield links(*rest)

    return run


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """root: the least node that each is linked to so far, always a root itself; changed in place."""
    while len(a):
        ra, rb = root[a], root[b]
        a, b, ra, rb = (x[ra != rb] for x in (a, b, ra, rb))
        if not len(a):
            return
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root[:] = up


def _node(fp: str, fp2: str, second: bool) -> Column:
    """The name of a node: its fingerprint, or both as text."""
    return F.concat(F.lpad(F.hex(fp), 16, "0"), F.lpad(F.hex(fp2), 16, "0")) if second else F.col(fp)


def near_links(nodes: DataFrame, *, max_bits: int, second_bits: int | None = None) -> DataFrame:
    """nodes (fp, fp2; distinct) -> links (a, b) that join exactly what differs in at most max_bits (second_bits) bits, directly or through others."""
    stats = _summed(nodes, BITS * BITS + 1, lambda fp: np.append((_bits(fp).T.astype(np.int64) @ _bits(fp).astype(np.int64)).ravel(), len(fp)))
    n = int(stats[-1])
    plan = Plan(group_bits(stats[:-1].reshape(BITS, BITS), n, widths_for(n, max_bits)), max_bits)
    plan.learn(_summed(nodes, int(plan.offsets[-1]), plan.histogram), n)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, fp2 = batch["fp"].to_numpy(), batch["fp2"].to_numpy()
            for key, cut, probe, own in plan.signatures(fp.view(np.uint64)):
                # one number for value and slice: two that meet by chance are compared in vain, at worst
                named = key ^ (cut.astype(np.uint64) * _MIX)
                yield pa.RecordBatch.from_arrays([pa.array(named.view(np.int64)), pa.array(np.full(len(key), probe)), pa.array(fp[own]), pa.array(fp2[own])], ["key", "probe", "fp", "fp2"])

    rows = nodes.select("fp", "fp2").mapInArrow(spread, "key long, probe boolean, fp long, fp2 long")
    found = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_linked(max_bits, second_bits), "a long, a2 long, b long, b2 long")
    second = second_bits is not None
    return found.select(_node("a", "a2", second).alias("a"), _node("b", "b2", second).alias("b"))


def near_duplicates(docs: DataFrame, *, shingle: int, max_bits: int, second_bits: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, fp, component_id (the smallest id that links reach)."""
    if shingle < 1 or not 0 <= max_bits <= 12:
        raise ValueError("shingle must be at least 1 and max_bits from 0 to 12")
    second = second_bits is not None
    rows = materialise(fingerprints(docs, shingle=shingle, second=second, id_col=id_col, text_col=text_col).withColumn("mine", _node("fp", "fp2", second)), "fingerprints")
    nodes = materialise(rows.groupBy("mine", "fp", "fp2").agg(F.min("id").alias("low")), "nodes")
    roots = components(near_links(nodes, max_bits=max_bits, second_bits=second_bits))
    rooted = nodes.join(roots, nodes.mine == roots.node, "left").select("mine", "low", F.coalesce("root", "mine").alias("root"))
    # what a join needs is written first, so that it may split the rows of a large component or a common fingerprint
    lowest = materialise(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = materialise(rooted.join(lowest, "root").select("mine", "component_id"), "named")
    return rows.join(named, "mine").select(F.col("id").alias(id_col), "fp", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint over 3-word shingles and its component at 3 differing bits."""
    out = near_duplicates(load(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
