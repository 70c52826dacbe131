"""Byte-level BPE encoding and decoding with DuckDB, a connection a partition.

Encoding: a text is split by the tokenizer's pattern; each distinct piece of a partition is encoded once. Pieces become
token-position rows; a recursive query joins neighbours with the merge table and contracts, in every piece, the leftmost pair of
minimum rank, until no piece has a pair. Decoding: ids join the vocabulary, and an ordered aggregation puts the bytes
together; invalid UTF-8 is possible, so bytes are returned.

A piece of over LONG bytes is first cut where no token of the vocabulary stands across: no pair there can ever be contracted, so the parts are encoded by
themselves. Parts that are still long contract all non-overlapping pairs of the minimum rank in one step, from the left up to the first whose
contraction makes a pair of lower rank with what then stands beside it: up to there the minimum stays, so this is the same order. Steps then
mostly follow the distinct ranks, not the length, and a step keeps one row a piece.

The vocabulary (ranks as in tiktoken's files) is a parameter, read by the driver and sent to tasks: its size is that of the file.
A partition remembers about REMEMBERED pieces, a cache that is emptied when full; memory does not grow with the partition.

Cases: a null text counts as empty: no ids. Special tokens are ordinary text. Unknown ids raise an error. A piece of any length
is encoded whole. Equal rows give equal results; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, to_python

REMEMBERED = 200_000
#: Texts encoded together: their new pieces share a query.
DOCS_AT_ONCE = 800
#: Characters of pieces that one recursive query takes at most, unless a single piece is longer.
QUERY_CHARS = 1_000_000

#: Bytes of a piece beyond which a step contracts every pair of the minimum rank.
LONG = 256

#: Rust's and Unicode's white space; Python's \s has four separators more.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the pattern of which it is known that a single blank between two solid characters always starts a piece.
AT_BLANKS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: So what stands before such a blank is split by itself. Texts of other patterns are split whole.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Tokens that one decoding query takes at most, unless a single text has more.
QUERY_TOKENS = 400_000


def _plain(text: str) -> bool:
    """Every blank stands between two solid characters. Printable text has no white space but blanks; line ends are looked at apart."""
    return text.replace("\n", "").isprintable() and not ("  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " ")


#: Each step makes a row of every position whose token has a neighbour; a pick holds the rank and, in its lower half, the place.
ENCODE = """
WITH RECURSIVE steps(w, ids, open) AS (
    SELECT w, ids, true FROM pieces
    UNION ALL
    (WITH line AS (
        SELECT w, unnest(ids[:-2]) AS a, unnest(ids[2:]) AS b, generate_subscripts(ids[2:], 1) AS place FROM steps WHERE open),
    best AS (
        SELECT w, min(merged << 32 | place) AS pick FROM line JOIN merges ON pair = (a::BIGINT << 32 | b) GROUP BY w)
    SELECT steps.w, CASE WHEN pick IS NULL THEN ids ELSE ids[:(pick & 4294967295) - 1] || [(pick >> 32)::INTEGER] || ids[(pick & 4294967295) + 2:] END, pick IS NOT NULL
    FROM steps LEFT JOIN best ON best.w = steps.w WHERE open))
SELECT w, ids FROM steps WHERE NOT open
"""

#: The same (1073741823 stands beyond either end) with all pairs of the minimum rank up to the first that makes a lower one; of a run of overlapping ones every other.
ENCODE_LONG = """
WITH RECURSIVE steps(w, ids, open) USING KEY (w) AS (
    SELECT w, ids, true FROM pieces
    UNION
    (WITH line AS (
        SELECT w, unnest(ids) AS a, unnest(ids[2:] || [1073741823]) AS b, unnest([1073741823] || ids[:-2]) AS prior, unnest(ids[3:] || [1073741823, 1073741823]) AS after, generate_subscripts(ids, 1) AS place
        FROM steps WHERE open),
    pairs AS (SELECT w, place, merged, prior, after FROM line JOIN merges ON pair = (a::BIGINT << 32 | b)),
    best AS (SELECT w, min(merged) AS merged FROM pairs GROUP BY w),
    hits AS (SELECT *, place - row_number() OVER (PARTITION BY w ORDER BY place) AS run FROM pairs SEMI JOIN best USING (w, merged)),
    picked AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY w, run ORDER BY place) % 2 = 1),
    beside AS (
        SELECT w, place, merged, merged << 32 | after AS then_pair,
            (CASE WHEN lag(place) OVER (PARTITION BY w ORDER BY place) = place - 2 THEN merged ELSE prior END) << 32 | merged AS prior_pair FROM picked),
    lower AS (
        SELECT w, min(place) AS place FROM beside WHERE EXISTS (FROM merges m WHERE m.pair = prior_pair AND m.merged < beside.merged)
            OR EXISTS (FROM merges m WHERE m.pair = then_pair AND m.merged < beside.merged) GROUP BY w),
    done AS (SELECT beside.w, beside.place, merged FROM beside LEFT JOIN lower ON lower.w = beside.w WHERE lower.place IS NULL OR beside.place <= lower.place),
    fresh AS (
        SELECT line.w, list(coalesce(here.merged, a)::INTEGER ORDER BY line.place) AS ids
        FROM line LEFT JOIN done here ON here.w = line.w AND here.place = line.place LEFT JOIN done gone ON gone.w = line.w AND gone.place + 1 = line.place
        WHERE gone.place IS NULL GROUP BY line.w)
    SELECT steps.w, fresh.ids, best.w IS NOT NULL
    FROM steps JOIN fresh ON fresh.w = steps.w LEFT JOIN best ON best.w = steps.w WHERE open))
SELECT w, ids FROM steps
"""

DECODE = """
SELECT doc, string_agg(v.chars, '' ORDER BY t.pos) AS chars
FROM tokens t JOIN vocabulary v ON v.id = t.id GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A tiktoken file: base64 of a token's bytes, blank, rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder of one vocabulary in one DuckDB connection."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.db = duckdb.connect(":memory:", config={"threads": 1, "temp_directory": ""})
        self.db.execute("SET preserve_insertion_order = false")
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}")
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        splits = [(ranks[t[:k]] << 32 | ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.ranks, self.starts = ranks, {t[:k] for t in ranks for k in range(1, len(t) + 1)}
        # Latin-1 characters stand for bytes: DuckDB aggregates strings, not blobs
        self._keep("merges", {"pair": pa.array([x for x, _ in splits], pa.int64()), "merged": pa.array([x for _, x in splits], pa.int64())})
        self._keep("vocabulary", {"id": pa.array(ranks.values(), pa.int32()), "chars": pa.array([t.decode("latin-1") for t in ranks])})
        self.is_id = np.zeros(max(ranks.values()) + 1, bool)
        self.is_id[list(ranks.values())] = True
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.at_blanks = pattern == AT_BLANKS
        self.pattern = regex.compile(pattern.replace(r"[^\s\p{L}", rf"[^{WHITE}\p{{L}}").replace(r"(?!\S)", rf"(?![^{WHITE}])").replace(r"\s+", rf"[{WHITE}]+"))
        #: Ids, four bytes each, of what a blank precedes (without the blank: whole chunks and single pieces alike), and of other pieces.
        self.led: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}

    def _keep(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.led) > REMEMBERED:
            self.led = {}
        if len(self.bare) > REMEMBERED // 4:
            self.bare = {}
        led, bare, split = self.led, self.bare, self.pattern.findall
        cut = [t.split(" ") if _plain(t) else _CUT.split(t) for t in texts] if self.at_blanks else [[t] for t in texts]
        tails = [chunks[1:] for chunks in cut]
        fresh = set().union(*tails).difference(led)
        # letters only: one piece
        several = {c: split(" " + c) for c in fresh if not c.isalpha()}
        heads = [split(chunks[0]) for chunks in cut]
        pieces = {p for some in (several.values(), heads) for own in some for p in own}
        fresh.difference_update(several)
        fresh.update(p[1:] for p in pieces if p[0] == " " and p[1:] not in led)
        self._contract(list(fresh), " ", led)
        self._contract([p for p in pieces if p[0] != " " and p not in bare], "", bare)
        ids = lambda own: b"".join([led[p[1:]] if p[0] == " " else bare[p] for p in own])
        led.update((c, ids(own)) for c, own in several.items())
        return [np.frombuffer(ids(head) + b"".join(map(led.__getitem__, tail)), np.int32) for head, tail in zip(heads, tails, strict=True)]

    def _contract(self, pieces: list[str], before: str, into: dict[str, bytes]) -> None:
        """Ids of pieces not known yet, by recursive queries."""
        first, size = 0, 0
        for k, p in enumerate(pieces):
            size += len(p) + 1
            if size >= QUERY_CHARS or k + 1 == len(pieces):
                todo = pieces[first : k + 1]
                whole = [(before + x).encode() for x in todo]
                short = [i for i, x in enumerate(whole) if len(x) <= LONG]
                into.update(zip(map(todo.__getitem__, short), self._query(list(map(whole.__getitem__, short)), ENCODE) if short else (), strict=True))
                if len(short) < len(todo):
                    self._contract_long({x: own for x, own in zip(todo, whole, strict=True) if len(own) > LONG}, into)
                first, size = k + 1, 0

    def _contract_long(self, pieces: dict[str, bytes], into: dict[str, bytes]) -> None:
        """Ids of long pieces: those of their parts, one after another."""
        parts = [self._parts(x) for x in pieces.values()]
        flat = [x for own in parts for x in own]
        got: list[bytes] = [b""] * len(flat)
        for how, some in ((ENCODE, [i for i, x in enumerate(flat) if len(x) <= LONG]), (ENCODE_LONG, [i for i, x in enumerate(flat) if len(x) > LONG])):
            for i, ids in zip(some, self._query([flat[i] for i in some], how) if some else (), strict=True):
                got[i] = ids
        told = iter(got)
        into.update((x, b"".join(islice(told, len(own)))) for x, own in zip(pieces, parts, strict=True))

    def _parts(self, piece: bytes) -> list[bytes]:
        """The piece, cut where no token stands across."""
        cuts, reach = [0], 0
        for at in range(len(piece)):
            if at and at == reach:
                cuts.append(at)
            reach, stop = max(reach, at + 1), at + 1
            while stop <= len(piece) and piece[at:stop] in self.starts:
                if stop > reach and piece[at:stop] in self.ranks:
                    reach = stop
                stop += 1
        return [piece[a:b] for a, b in zip(cuts, [*cuts[1:], len(piece)], strict=True)]

    def _query(self, todo: list[bytes], how: str) -> list[bytes]:
        offsets = np.cumsum([0, *map(len, todo)]).astype(np.int32)
        ids = self.byte_id[np.frombuffer(b"".join(todo), np.uint8)]
        self.db.register("pieces", pa.table({"w": pa.array(np.arange(len(todo), dtype=np.int32)), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))}))
        got = self.db.sql(how).to_arrow_table()
        self.db.unregister("pieces")
        lists = got["ids"].combine_chunks()
        raw, at = np.asarray(lists.flatten(), np.int32).tobytes(), (lists.offsets.to_numpy() - lists.offsets[0].as_py()) * 4
        out = [b""] * len(todo)
        for k, start, stop in zip(got["w"].to_numpy().tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
            out[k] = raw[start:stop]
        return out

    def decode(self, texts: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids, by ordered aggregations."""
        out, first, size = [b""] * len(texts), 0, 0
        for k, ids in enumerate(texts):
            size += len(ids)
            if size >= QUERY_TOKENS or k + 1 == len(texts):
                for i, chars in self._aggregate(texts[first : k + 1]):
                    out[first + i] = chars.encode("latin-1")
                first, size = k + 1, 0
        return out

    def _aggregate(self, texts: list[np.ndarray]) -> list[tuple[int, str]]:
        ids = np.concatenate(texts).astype(np.int32)
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(x) for x in texts])
        if len(ids) and not (ids.min() >= 0 and ids.max() < len(self.is_id) and self.is_id[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        self._keep("tokens", {"doc": pa.array(doc), "pos": pa.array(np.arange(len(ids), dtype=np.int32)), "id": pa.array(ids)})
        return self.db.execute(DECODE).fetchall()


def _encoded(ranks: dict[bytes, int], pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Codec, list[np.ndarray]]]:
    """Slices of ids of rows with the ids of their texts, DOCS_AT_ONCE or fewer at a time."""
    codec = None
    for batch in batches:
        codec = codec or Codec(ranks, pattern)
        for at in range(0, batch.num_rows, DOCS_AT_ONCE):
            part = batch.slice(at, DOCS_AT_ONCE)
            yield part["id"], codec, codec.encode([t or "" for t in part["text"].to_pylist()])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    return to_python(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))), docs.schema[id_col].dataType.simpleString()


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids array<int> of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, ids in _encoded(ranks, pattern, batches):
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([rows, lists], ["id", "ids"])

    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, ranks: dict[bytes, int], pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col, decoded binary: the bytes that the ids stand for. A null list has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(ranks, pattern)
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                ids = [np.asarray(x.values if x.is_valid else [], np.int32) for x in part["ids"]]
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(codec.decode(ids), pa.binary())], ["id", "decoded"])

    kind = tokens.schema[id_col].dataType.simpleString()
    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256: encode() and decode() of each row in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = {}
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for rows, codec, ids in _encoded(ranks, pattern, batches):
            decimal = decimal or {i: str(i) for i in codec.bytes_of}
            said = [sha(",".join(map(decimal.__getitem__, x.tolist())).encode()) for x in ids]
            yield pa.RecordBatch.from_arrays([rows, pa.array([len(x) for x in ids], pa.int64()), pa.array(said), pa.array(list(map(sha, codec.decode(ids))))], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows, kind = _rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents, encoded and decoded again."""
    return production_round_trip(load(spark, sf_dir, "documents"))


def production_round_trip(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return round_trip(docs, read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
