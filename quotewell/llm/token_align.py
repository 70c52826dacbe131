"""Alignment of two tokenizers' tokens over the same bytes, with DuckDB, a connection a partition.

A text is cut at single blanks between solid characters: there both tokenizers begin a token (checked on their files; texts of other tokenizers stay whole), so
no overlap and no group goes across, and each distinct chunk of a partition is aligned once. The tokens of new chunks become two interval tables on one axis of
bytes. An ASOF join gives the B token at which each A token starts, a range join the B tokens that start inside it: together all overlaps. Running sums over
the places where tokens of both end number the groups.

One pass over the texts counts the chunks of a partition, joins the counts with the chunks' overlaps, and emits partial counts of id pairs, which Spark adds up, beside each
document's own pairs. Fewer than HEAVY pairs can have more than 1 / HEAVY of all links each; these go to every task, which scores a document's links by them. The
rest, of which none is frequent, goes row by row to a join with their counts. So a pair that a third of all links have is never one task's work.

Cases: null and empty texts, and texts that either tokenizer's tokens don't give back byte by byte, have no tokens: zeros, and '' for their groups. Special tokens'
strings are plain text. Texts of any length are whole; one without blanks is one chunk. Repeated rows and ids are told apart; empty tables give none. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import _CUT, _plain
from .common import discard, load, materialise, to_python

#: Pairs that every task is sent are fewer than this: 17 bytes each.
HEAVY = 1 << 20
#: Chunks that a partition remembers, and their bytes, before it starts anew.
REMEMBERED, REMEMBERED_BYTES = 200_000, 24 << 20
#: Characters of the texts handled together, unless one has more.
CHARS_AT_ONCE = 1 << 19

#: New chunks that A encodes as one text.
JOINED = 256

PAIRS = """
SELECT chunk, a * {b_ids} + b AS pair, count(*)::BIGINT AS n FROM (
    SELECT a.chunk, a.id AS a, b.id AS b FROM a ASOF JOIN b ON a.s >= b.s
    UNION ALL
    SELECT a.chunk, a.id, b.id FROM a JOIN (SELECT id, s FROM b ANTI JOIN a ON a.s = b.s) b ON b.s > a.s AND b.s < a.e)
GROUP BY ALL
"""

#: Every token with its group's number: at the end of a group, its own end counts for the next.
GROUPS = """
WITH ends AS (SELECT a.e FROM a SEMI JOIN b ON b.e = a.e),
numbered AS (
    SELECT chunk, 0 AS side, s, id, sum((ends.e IS NOT NULL)::INTEGER) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - (ends.e IS NOT NULL)::INTEGER AS part FROM a LEFT JOIN ends ON ends.e = a.e
    UNION ALL
    SELECT chunk, 1, s, id, sum((ends.e IS NOT NULL)::INTEGER) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) - (ends.e IS NOT NULL)::INTEGER FROM b LEFT JOIN ends ON ends.e = b.e)
SELECT chunk, side, id, part::BIGINT AS part, s FROM numbered
"""


@dataclass(frozen=True)
class Tokenizers:
    """A: a byte-level BPE as JSON. B: a sentencepiece model that adds the leading blank. Both are sent to tasks by value."""

    a_json: str
    b_model: bytes

    @staticmethod
    def read(a_path: str, b_path: str) -> Tokenizers:
        with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
            return Tokenizers(a.read(), b.read())


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 stands for itself, other bytes for characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Pair:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, given: Tokenizers) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(given.a_json), SentencePieceProcessor(model_proto=given.b_model)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_flat, self.b_flat = (np.frombuffer(b"".join(x), np.uint8) for x in (self.a_bytes, self.b_bytes))
        how = json.loads(given.a_json)
        split = how.get("pre_tokenizer") or {}
        self.cuts = how.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not any(re.search("[^▁]▁", p) for p in pieces)

    def encode(self, chunks: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """(ids, tokens of each chunk) by A, of blank + chunk, and by B, of chunk; and which chunks both give back, byte by byte."""
        both = [self._encode_a(chunks), self._flat(self.b.encode(chunks, num_threads=1))]
        want = [(" " + c).encode() for c in chunks]
        length = np.array(list(map(len, want)), np.int64)
        good, out = length > 1, []
        for (ids, count), size, flat in zip(both, (self.a_size, self.b_size), (self.a_flat, self.b_flat), strict=True):
            owner = np.repeat(np.arange(len(chunks)), count)
            good &= np.bincount(owner, size[ids], len(chunks)).astype(np.int64) == length
            # the bytes, of chunks whose length is right
            here = good[owner]
            some, wide = ids[here], size[ids[here]]
            said = flat[np.repeat((np.cumsum(size) - size)[some] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())]
            differ = np.nonzero(said != np.frombuffer(b"".join([w for w, ok in zip(want, good.tolist(), strict=True) if ok]), np.uint8))[0]
            good[np.nonzero(good)[0][np.searchsorted(np.cumsum(length[good]), differ, side="right")]] = False
            out.append((ids, count))
        return out, good


    @staticmethod
    def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        count = np.array(list(map(len, lists)), np.int64)
        return np.fromiter(chain.from_iterable(lists), np.int64, int(count.sum())), count

    def _encode_a(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, tokens of each chunk) of blank + chunk. Chunks with solid ends are encoded JOINED at a time, and told apart by their bytes, as both tokenizers cut between them."""
        solid = 0
        while self.cuts and solid < len(chunks) and _solid(chunks[solid]):
            solid += 1
        joined = [" " + " ".join(chunks[k : min(k + JOINED, solid)]) for k in range(0, solid, JOINED)]
        ids, _ = self._flat([e.ids for e in self.a.encode_batch_fast(joined, add_special_tokens=False)])
        at = np.searchsorted(np.cumsum(self.a_size[ids]), np.cumsum([len(c.encode()) + 1 for c in chunks[:solid]]))
        more, count = self._flat([e.ids for e in self.a.encode_batch_fast([" " + c for c in chunks[solid:]], add_special_tokens=False)])
        return np.concatenate([ids, more]), np.concatenate([np.diff(at + 1, prepend=0), count])


def _solid(chunk: str) -> bool:
    return chunk != "" and chunk.strip() == chunk


class Aligner:
    """Aligned chunks of one partition. Chunk k has row k of `sizes` (A tokens, B tokens, groups, links), groups[k], and the pairs from links[k] to links[k + 1]."""

    def __init__(self, given: Tokenizers) -> None:
        self.pair = Pair(given)
        self.b_ids = len(self.pair.b_bytes)
        decimal = [str(i) for i in range(max(len(self.pair.a_bytes), self.b_ids))]
        #: Decimal ids with what may follow: another of the side, the other side, another group, another chunk.
        self.said = np.array([[d + after for d in decimal] for after in ",|;\n"], object)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "temp_directory": ""})
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)
        self.links, self.pair_ids, self.pair_times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held = 0

    @property
    def full(self) -> bool:
        return len(self.place) > REMEMBERED or self.held > REMEMBERED_BYTES

    def chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The places of all texts' chunks, and how many each text has; texts without tokens have none."""
        cut = [[t] if not self.pair.cuts else t.split(" ") if _plain(t) else _CUT.split(t) for t in texts]
        self._add(set(chain.from_iterable(cut)))
        count = np.array(list(map(len, cut)), np.int64)
        places = np.fromiter(map(self.place.__getitem__, chain.from_iterable(cut)), np.int64, int(count.sum()))
        good = np.logical_and.reduceat(self.good[places], np.cumsum(count) - count) if len(texts) else np.zeros(0, bool)
        # chunks that differ may still make up the text's bytes together: then it is one chunk
        whole = np.nonzero(~good & (count > 1))[0].tolist()
        self._add({texts[k] for k in whole})
        own = np.split(places, np.cumsum(count)[:-1])
        for k in np.nonzero(~good)[0].tolist():
            own[k] = own[k][:0]
        for k in whole:
            if self.good[at := self.place[texts[k]]]:
                own[k] = np.array([at], np.int64)
        return np.concatenate([*own, np.zeros(0, np.int64)]), np.array(list(map(len, own)), np.int64)

    def _add(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.place]
        if not new:
            return
        new.sort(key=_solid, reverse=True)
        first = len(self.place)
        self.place.update(zip(new, range(first, first + len(new))))
        sides, good = self.pair.encode(new)
        sizes = np.zeros((len(new), 4), np.int64)
        for side, (name, (ids, count), size) in enumerate(zip("ab", sides, (self.pair.a_size, self.pair.b_size), strict=True)):
            owner = np.repeat(np.arange(len(new)), count)
            owner, ids = owner[good[owner]], ids[good[owner]]
            sizes[:, side] = np.where(good, count, 0)
            ends = np.cumsum(size[ids])
            self.db.register("incoming", pa.table({"chunk": owner, "id": ids, "s": ends - size[ids], "e": ends}))
            self.db.execute(f"CREATE OR REPLACE TABLE {name} AS FROM incoming")
            self.db.unregister("incoming")
        chunk, pair, n = self.db.execute(PAIRS.format(b_ids=self.b_ids)).fetchnumpy().values()
        sizes[:, 3] = np.bincount(chunk, n, len(new))
        self.links = np.concatenate([self.links, self.links[-1] + np.cumsum(np.bincount(chunk, minlength=len(new)))])
        order = np.argsort(chunk, kind="stable")
        self.pair_ids, self.pair_times = np.concatenate([self.pair_ids, pair[order]]), np.concatenate([self.pair_times, n[order]])
        groups = [""] * len(new)
        chunk, side, ids, part, s = self.db.execute(GROUPS).fetchnumpy().values()
        order = np.argsort((part * 2 + side) << 32 | s, kind="stable")  # both sides come in order: two runs to merge
        chunk, side, ids, part = chunk[order], side[order], ids[order], part[order]
        if len(chunk):
            sizes[:, 2] = np.bincount(chunk[np.append(True, part[1:] != part[:-1])], minlength=len(new))
            after = np.where(chunk[1:] != chunk[:-1], 3, np.where(part[1:] != part[:-1], 2, np.where(side[1:] != side[:-1], 1, 0)))
            texts = "".join(self.said[np.append(after, 3), ids].tolist()).split("\n")
            for k, text in zip(chunk[np.append(after == 3, True)].tolist(), texts[:-1], strict=True):
                groups[k] = text
        self.good = np.concatenate([self.good, good])
        self.groups += groups
        self.sizes = np.concatenate([self.sizes, sizes])
        self.held += sum(map(len, groups)) + sum(map(len, new))

    def pairs_of(self, places: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, pair, links) of chunks: an owner's equal pairs are added up."""
        many = self.links[places + 1] - self.links[places]
        at = np.repeat(self.links[places] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        owner, pair, n = np.repeat(owner, many), self.pair_ids[at], self.pair_times[at]
        order = np.lexsort((pair, owner))
        owner, pair, n = owner[order], pair[order], n[order]
        if not len(order):
            return owner, pair, n
        first = np.nonzero(np.append(True, (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])))[0]
        return owner[first], pair[first], np.add.reduceat(n, first)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    for batch in batches:
        texts = [t or "" for t in batch["text"].to_pylist()]
        first = size = 0
        for k, t in enumerate(texts):
            size += len(t)
            if size >= CHARS_AT_ONCE or k + 1 == len(texts):
                yield batch["id"].slice(first, k + 1 - first), texts[first : k + 1]
                first, size = k + 1, 0


def _lists(owner: np.ndarray, owners: int, *columns: np.ndarray) -> list[pa.Array]:
    offsets = pa.array(np.searchsorted(owner, np.arange(owners + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in columns]


def aligned_rows(docs: DataFrame, given: Tokenizers, *, id_col: str, text_col: str, digest: bool) -> DataFrame:
    """Rows of documents (key, id, n_a, n_b, n_groups, n_links, groups, pairs, times) and, with a null key, of partial counts (pairs, times)."""
    sent = docs.sparkSession.sparkContext.broadcast(given)
    kind = docs.schema[id_col].dataType
    names = ["key", "id", *NUMBERS, "groups", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, seen, key = Aligner(sent.value), np.zeros(0, np.int64), TaskContext.get().partitionId() << 33
        ids_of = pa.null()

        def counted() -> pa.RecordBatch:
            places = np.nonzero(seen)[0]
            db = aligner.db
            many = aligner.links[1:] - aligner.links[:-1]
            db.register("met", pa.table({"chunk": places, "times": seen[places]}))
            db.register("chunk_pairs", pa.table({"chunk": np.repeat(np.arange(len(many)), many), "pair": aligner.pair_ids, "n": aligner.pair_times}))
            pair, n = db.execute("SELECT pair, sum(n * times)::BIGINT AS n FROM chunk_pairs JOIN met USING (chunk) GROUP BY pair").fetchnumpy().values()
            empty = [pa.nulls(1, pa.int64()), pa.nulls(1, ids_of), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string())]
            return pa.RecordBatch.from_arrays([*empty, *_lists(np.zeros(len(pair), np.int64), 1, pair, n)], names)

        for ids, texts in _slices(batches):
            ids_of = ids.type
            places, count = aligner.chunks(texts)
            seen = np.concatenate([seen, np.zeros(len(aligner.groups) - len(seen), np.int64)]) + np.bincount(places, minlength=len(aligner.groups))
            sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(aligner.sizes[places], 0)])
            ends = np.cumsum(count)
            sums = sums[ends] - sums[ends - count]
            text = [";".join(map(aligner.groups.__getitem__, own.tolist())) for own in np.split(places, ends[:-1])]
            if digest:
                text = [t and hashlib.sha256(t.encode()).hexdigest() for t in text]
            owner, pair, n = aligner.pairs_of(places, np.repeat(np.arange(len(texts)), count))
            keys = pa.array(np.arange(key, key + len(texts)))
            key += len(texts)
            yield pa.RecordBatch.from_arrays([keys, ids, *map(pa.array, sums.T), pa.array(text, pa.string()), *_lists(owner, len(texts), pair, n)], names)
            if aligner.full:
                yield counted()
                aligner.forget()
                seen = seen[:0]
        if len(seen):
            yield counted()

    rows = to_python(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
    schema = f"key long, id {kind.simpleString()}, {', '.join(f'{c} long' for c in NUMBERS)}, groups string, pairs array<long>, times array<long>"
    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, given: Tokenizers) -> DataFrame:
    """pair (A id times B's number of ids, plus B id), b, total (links of all documents that hold it), best (no other pair of its B id has more)."""
    b_ids = len(Pair(given).b_bytes)
    partial = aligned.where("key IS NULL").select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    totals = materialise(partial.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair") % b_ids), "pair-totals")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))  # a row a B id
    return totals.join(F.broadcast(most), "b").select("pair", "b", "total", (F.col("total") == F.col("most")).alias("best"))


def align(docs: DataFrame, given: Tokenizers, *, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, heavy: int = HEAVY) -> DataFrame:
    """id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (decimal ids, `a1,a2|b1;a3|b2,b3`) or groups_sha256 of every whole text."""
    aligned = materialise(aligned_rows(docs, given, id_col=id_col, text_col=text_col, digest=digest), "aligned")
    counts = materialise(pair_counts(aligned, given), "pairs")
    links = counts.agg(F.sum("total")).first()[0] or 0
    # fewer than `heavy` pairs can have more than links / heavy each
    frequent = counts.where(F.col("total") > links // heavy).select("pair", "total", F.col("best").cast("long")).toArrow().sort_by("pair")
    sent = docs.sparkSession.sparkContext.broadcast(tuple(frequent[c].to_numpy() for c in ("pair", "total", "best")))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, best = sent.value
        for batch in batches:
            lists = batch["pairs"]
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            pair, n = lists.flatten().to_numpy(), batch["times"].flatten().to_numpy()
            at = np.searchsorted(known, pair)
            here = at < len(known)
            here[here] = known[at[here]] == pair[here]
            sums = []
            for per_link in (best, total):
                running = np.concatenate([[0], np.cumsum(per_link[at[here]] * n[here])])
                ends = np.searchsorted(owner[here], np.arange(batch.num_rows + 1))
                sums.append(pa.array(running[ends[1:]] - running[ends[:-1]]))
            rare = _lists(owner[~here], batch.num_rows, pair[~here], n[~here])
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("key", "id", *NUMBERS, "groups")), *sums, *rare], ["key", "id", *NUMBERS, "groups", "n_best", "count_sum", "rare", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"key long, id {kind}, {', '.join(f'{c} long' for c in NUMBERS)}, groups string, n_best long, count_sum long, rare array<long>, times array<long>"
    scored = materialise(to_python(aligned.where("key IS NOT NULL")).mapInArrow(score, schema), "scored")
    discard(aligned)
    loose = scored.select("key", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("key", F.col("x.rare").alias("pair"), F.col("x.times").alias("times"))
    more = loose.join(counts, "pair").groupBy("key").agg(F.sum(F.col("best").cast("long") * F.col("times")).alias("more_best"), F.sum(F.col("total") * F.col("times")).alias("more_sum"))
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    named = "groups_sha256" if digest else "groups"
    return scored.join(more, "key", "left").select(F.col("id").alias(id_col), *NUMBERS, plus("n_best", "more_best"), plus("count_sum", "more_sum"), F.col("groups").alias(named))


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def production() -> Tokenizers:
    import public_tokenizers

    return Tokenizers.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents, by both tokenizers."""
    return align(load(spark, sf_dir, "documents"), production(), digest=True)
