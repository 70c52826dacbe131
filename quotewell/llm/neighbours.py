"""Approximate nearest neighbours by cosine: a robust-pruned directed graph a shard, searched by beams.

Equal vectors are one node, which keeps the smallest ids it needs (no answer can name more of them). Nodes are dealt to shards by the hash of
their vector; a shard is bounded by rows and bytes, so shards, not tasks, grow with the table. In a shard, nodes join the graph in batches: a greedy
search of the graph so far proposes neighbours, and a proposal c goes if some nearer, kept neighbour k has RELAX * |k - c| <= |p - c|; what stays is near
and diverse. Edges are then added the other way, and full lists are pruned by the same rule. The index is a table (shard, node, ids, vector, edges), so
it can be kept and searched again.

A search deals queries to blocks; each (shard, block) is a task of bounded size that walks the graph with a beam for all its queries in step. The nodes
found are scored again in double precision on the original vectors, and the shards' answers are ranked together: nearest first, ties to the smaller id.

Cases: rows with a null id, and vectors that are null, empty, zero or hold null or non-finite components, take no part. Vectors are compared with those of
their own length. A row is never its own neighbour, and neither are rows that share its id; a repeated id with several vectors is a query for each of them,
ranked together. Fewer candidates than asked for give fewer rows; empty tables give none. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import load, materialise

#: Nodes of a shard, and bytes of its vectors, at most (on average: nodes are dealt by hash).
SHARD_ROWS, SHARD_BYTES = 8192, 64 << 20
#: Queries of a block, on average.
BLOCK_QUERIES = 65_536
#: Edges of a node at most, width of the beam that proposes them, and the relaxation of their pruning.
DEGREE, BUILD_BEAM, RELAX = 32, 64, 1.2
#: Width of the beam of a search. Recall is measured against brute force in the tests.
SEARCH_BEAM = 256
#: Nodes from which walks begin.
ENTRIES = 32
#: Nodes that join at once, and queries that walk at once.
AT_ONCE = 512
#: Pairs of vectors that are scored at once.
PAIRS = 65_536
#: Nodes of each beam that a step expands.
EXPAND = 4


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one. Scaling by a power of two first keeps squares finite."""
    scaled = _scaled(vectors)
    return (scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))).astype(np.float32)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component to [0.5, 1): cosines stay, to the last bit."""
    wide = vectors.astype(np.float64)
    return np.ldexp(wide, -np.frexp(np.abs(wide).max(1, keepdims=True))[1])


def _squared(vectors: np.ndarray) -> np.ndarray:
    return np.einsum("...j,...j->...", vectors, vectors)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with that of b, in double precision; components are added in order, so equal vectors score equally."""
    a, b = _scaled(a), _scaled(b)
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for x, y in zip(a.T, b.T, strict=True):
        dot, aa, bb = dot + x * y, aa + x * x, bb + y * y
    return dot / (np.sqrt(aa) * np.sqrt(bb))


class Graph:
    """Unit vectors and the directed edges between them; -1 fills short lists."""

    def __init__(self, unit: np.ndarray, edges: np.ndarray | None = None) -> None:
        self.unit = unit
        self.edges = np.full((len(unit), DEGREE), -1, np.int32) if edges is None else edges
        order = np.random.default_rng(7).permutation(len(unit)).astype(np.int32)
        #: Where walks begin: the node nearest to the mean, and some drawn with a fixed seed, as one dense cluster may hold the middle.
        self.entries = np.unique(np.append(order[: ENTRIES - 1], np.argmax(unit @ unit.mean(0)))) if len(unit) else order
        if edges is not None:
            self._reach_all()

    def build(self) -> Graph:
        """Every node joins, in batches that double up to AT_ONCE; the entries, which know each other, are first, and the order is drawn with a fixed seed."""
        order = np.random.default_rng(8).permutation(len(self.unit)).astype(np.int32)
        order = np.concatenate([self.entries, order[~np.isin(order, self.entries)]])
        done = len(self.entries)
        self.edges[self.entries] = self._prune(self.entries, np.tile(self.entries, (done, 1)))
        while done < len(order):
            batch = order[done : done + min(done, AT_ONCE)]
            seen = self.walk(self.unit[batch], BUILD_BEAM)[2]
            self.edges[batch] = self._prune(batch, seen)
            self._add_back(batch)
            done += len(batch)
        self._reach_all()
        return self

    def _reach_all(self) -> None:
        """Pruning may cut a node off: what no walk from the entries can reach is an entry, too."""
        reached = np.zeros(len(self.unit), bool)
        front = self.entries
        while len(front):
            reached[front] = True
            front = np.unique(self.edges[front])
            front = front[front >= 0]
            front = front[~reached[front]]
        self.entries = np.concatenate([self.entries, np.nonzero(~reached)[0].astype(np.int32)])

    def walk(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy search for all queries in step. The beam's nodes, nearest first (infinitely far ones fill), their distances, and all nodes expanded on the way."""
        n = len(queries)
        rows = np.arange(n)[:, None]
        far = _squared(queries[:, None, :] - self.unit[self.entries])
        order = np.argsort(far, 1, kind="stable")[:, :beam]
        nodes, far = self.entries[order], far[rows, order]
        spent = np.zeros(nodes.shape, bool)
        met = np.zeros((n, len(self.unit)), bool)
        met[:, self.entries] = True
        seen = []
        while not spent.all():
            # the nearest EXPAND that were not expanded; beams are kept in order
            nth = np.cumsum(~spent, 1)
            picked = ~spent & (nth <= EXPAND)
            spent |= picked
            now = np.full((n, EXPAND), -1, np.int32)
            at = np.nonzero(picked)
            now[at[0], nth[at] - 1] = nodes[at]
            seen.append(now)
            fresh = np.where((now >= 0)[:, :, None], self.edges[now], -1).reshape(n, -1)
            fresh.sort(1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            fresh[met[rows, fresh]] = -1
            fresh = -np.sort(-fresh, 1)[:, : max(1, int((fresh >= 0).sum(1).max(initial=0)))]
            held = fresh >= 0
            met[np.broadcast_to(rows, fresh.shape)[held], fresh[held]] = True
            near = np.full(fresh.shape, np.inf, np.float32)
            near[held] = _squared(queries[np.nonzero(held)[0]] - self.unit[fresh[held]])
            all_nodes, all_far = np.concatenate([nodes, fresh], 1), np.concatenate([far, near], 1)
            all_spent = np.concatenate([spent, ~held], 1)
            best = np.argsort(all_far, 1, kind="stable")[:, :beam]
            nodes, far, spent = all_nodes[rows, best], all_far[rows, best], all_spent[rows, best]
            spent |= np.isinf(far)
        return nodes, far, np.concatenate(seen, 1)

    def _prune(self, points: np.ndarray, proposed: np.ndarray) -> np.ndarray:
        """DEGREE neighbours at most of each point: from the nearest proposal on, whatever a kept neighbour comes RELAX times nearer to goes."""
        n = len(points)
        rows = np.arange(n)[:, None]
        proposed = np.sort(proposed, 1)
        proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
        proposed[proposed == points[:, None]] = -1
        # seen from the point itself: near copies differ by less than single precision tells of whole vectors
        vectors = self.unit[proposed] - self.unit[points][:, None, :]
        far = _squared(vectors)
        far[proposed < 0] = np.inf
        order = np.argsort(far, 1, kind="stable")
        proposed, far, vectors = proposed[rows, order], far[rows, order], vectors[rows, order]
        square = _squared(vectors)
        between = (square[:, :, None] + square[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)) * np.float32(RELAX**2)
        alive, kept = np.isfinite(far), np.full((n, DEGREE), -1, np.int32)
        for k in range(DEGREE):
            first = alive.argmax(1)
            has = alive[rows[:, 0], first]
            if not has.any():
                break
            kept[has, k] = proposed[has, first[has]]
            alive &= between[rows[:, 0], first] > far
            alive[rows[:, 0], first] = False
        return kept

    def _add_back(self, batch: np.ndarray) -> None:
        """Edges from the new nodes' neighbours to them; DEGREE of a node's at a time, so that a hub's list is pruned in bounded pieces."""
        to, frm = self.edges[batch].ravel(), np.repeat(batch, DEGREE)
        order = np.lexsort((frm[to >= 0], to[to >= 0]))
        frm, to = frm[to >= 0][order], to[to >= 0][order]
        nth = np.arange(len(to)) - np.searchsorted(to, to)
        for turn in range(int(nth.max(initial=-1)) // DEGREE + 1):
            now = nth // DEGREE == turn
            points, where = np.unique(to[now], return_inverse=True)
            offered = np.full((len(points), 2 * DEGREE), -1, np.int32)
            offered[:, :DEGREE] = self.edges[points]
            offered[where, DEGREE + nth[now] % DEGREE] = frm[now]
            room = (offered >= 0).sum(1) <= DEGREE
            self.edges[points[room]] = -np.sort(-offered[room], 1)[:, :DEGREE]
            for part in np.array_split(np.nonzero(~room)[0], max(1, (~room).sum() // AT_ONCE)):
                self.edges[points[part]] = self._prune(points[part], offered[part])


def _directions(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one direction share a place in the graph: the first node of each, in order, and each node's place."""
    packed = np.ascontiguousarray(unit + np.float32(0)).view(f"V{unit.itemsize * unit.shape[1]}").ravel()
    _, first, member = np.unique(packed, return_index=True, return_inverse=True)
    order = np.argsort(first)
    place = np.empty(len(first), np.int32)
    place[order] = np.arange(len(first))
    return first[order].astype(np.int32), place[member]


def _spread(left: np.ndarray, groups: np.ndarray, items: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of left with every item of its group; group g has items[starts[g]:starts[g + 1]]."""
    many = starts[groups + 1] - starts[groups]
    return np.repeat(left, many), items[np.repeat(starts[groups] - np.concatenate([[0], np.cumsum(many)])[:-1], many) + np.arange(many.sum())]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector of the rows that take part. -0 becomes 0, so that equal vectors have equal bytes."""
    plain = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    return plain.where(F.col("id").isNotNull() & _usable(F.col("vector"))).withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.abs(x)).otherwise(x)))


def build_index(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", answers: int = 5, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row a node: length, shard, node, ids (the smallest answers + 1 of those that have the vector), vector, edges (nodes of the shard).

    Written to the shared folder, so that a lost executor costs no graph that is done.
    """
    vectors = _vectors(rows, id_col, vector_col)
    # a rank below a limit: each map task passes on no more rows of a vector than that, however often it comes
    first = Window.partitionBy("vector").orderBy("id")
    few = vectors.distinct().withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= answers + 1)
    nodes = materialise(few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("length", F.size("vector")), "vectors")
    sizes = nodes.agg(F.count("*").alias("n"), F.max("length").alias("longest")).first()
    fits = max(1, min(shard_rows, SHARD_BYTES // (8 * (sizes.longest or 1))))
    shards = max(1, math.ceil(sizes.n / fits))
    kind = nodes.schema["vector"].dataType.simpleString()
    schema = f"length int, shard int, node int, ids array<bigint>, vector {kind}, edges array<int>"

    def build(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(np.array([x[0].as_py() for x in table["ids"]]), kind="stable")
        table = table.take(pa.array(order))
        unit, n = _unit(_matrix(table["vector"], key[0].as_py())), len(order)
        first = _directions(unit)[0]
        edges = np.full((n, DEGREE), -1, np.int32)
        graph = Graph(unit[first]).build()
        edges[first] = np.where(graph.edges >= 0, first[graph.edges], -1)
        held = edges >= 0
        edges = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held.sum(1))]).astype(np.int32)), pa.array(edges[held]))
        same = [pa.array(np.full(n, x.as_py(), np.int32)) for x in key]
        return pa.table([*same, pa.array(np.arange(n, dtype=np.int32)), table["ids"], table["vector"], edges], ["length", "shard", "node", "ids", "vector", "edges"])

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int")).select("length", "shard", "ids", "vector")
    return materialise(dealt.groupBy("length", "shard").applyInArrow(build, schema), "graphs")


def search(index: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", answers: int = 5, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the nearest rows of the index that the beams found, own id excluded."""
    asked = materialise(_vectors(queries, id_col, vector_col).distinct().withColumn("length", F.size("vector")), "asked")
    blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    shards = index.select("length", "shard").distinct().toDF("length", "part")
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).join(F.broadcast(shards) if blocks == 1 else shards, "length")
    every = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    answer = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(key: tuple, nodes: pa.Table, asked: pa.Table) -> pa.Table:
        if not nodes.num_rows or not asked.num_rows:
            return answer.empty_table()
        nodes = nodes.take(pa.array(np.argsort(nodes["node"].to_numpy())))
        vectors, ids = _matrix(nodes["vector"], key[0].as_py()), nodes["ids"].combine_chunks()
        lists = nodes["edges"].combine_chunks()
        counts = lists.value_lengths().to_numpy()
        edges = np.full((len(vectors), DEGREE), -1, np.int32)
        edges[np.arange(DEGREE) < counts[:, None]] = lists.flatten().to_numpy()
        unit = _unit(vectors)
        first, member = _directions(unit)
        at = np.full(len(unit) + 1, -1, np.int32)
        at[first] = np.arange(len(first))
        graph = Graph(unit[first], at[edges[first]])
        names, starts = ids.flatten().to_numpy(), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])
        wanted, own = _matrix(asked["vector"], key[0].as_py()), asked["id"].to_numpy()
        return pa.Table.from_batches(list(_answers(graph, member, vectors, names, starts, wanted, own, answers, beam)), answer)

    found = every.groupBy("length", "shard", "block").cogroup(dealt.groupBy("length", "part", "block")).applyInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= answers).select("query_id", "rank", "vec_id", "score")


def _answers(graph: Graph, member: np.ndarray, vectors: np.ndarray, names: np.ndarray, starts: np.ndarray, wanted: np.ndarray, own: np.ndarray, answers: int, beam: int) -> Iterator[pa.RecordBatch]:
    """The best rows of one shard for each query. The nearest nodes by single precision, with some to spare, are scored in double."""
    by_direction = np.argsort(member, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(member))])
    for at in range(0, len(own), AT_ONCE):
        some, mine = wanted[at : at + AT_ONCE], own[at : at + AT_ONCE]
        nodes = graph.walk(_unit(some), beam)[0][:, : 4 * (answers + 1)]
        query, place = np.nonzero(nodes >= 0)
        # a direction stands for its vectors, a vector for the rows that have it
        query, node = _spread(query, nodes[query, place], by_direction, ends)
        score = np.concatenate([cosines(some[query[k : k + PAIRS]], vectors[node[k : k + PAIRS]]) for k in range(0, len(node), PAIRS)] or [np.zeros(0)])
        turn, place = _spread(np.arange(len(node)), node, np.arange(len(names)), starts)
        query, score, name = query[turn], score[turn], names[place]
        order = np.lexsort((name, -score, query))
        order = order[name[order] != mine[query[order]]]
        nth = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[nth < answers]
        yield pa.RecordBatch.from_arrays([pa.array(mine[query[order]]), pa.array(name[order]), pa.array(score[order])], ["query_id", "vec_id", "score"])


#: The stated query set: rows whose id is divisible by this.
QUERY_EVERY = 50


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of all embeddings to each row whose vec_id is divisible by QUERY_EVERY."""
    rows = load(spark, sf_dir, "embeddings")
    return search(build_index(rows), rows.where(F.col("vec_id") % QUERY_EVERY == 0))
