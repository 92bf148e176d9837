"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Rows of equal vectors are one node, which keeps its smallest ids: a vector that a third of all rows share is one node like any
other. A first graph comes from blocks: a few random-projection trees, fitted on a bounded sample, bring alike vectors
next to each other, the order is cut into blocks of fixed size, and each block's nodes are compared with one another. Then
rounds of joins look at the neighbours of neighbours: every node is a hub that gathers some of the nodes it points at and some
of those that point at it; all pairs it has gathered, one of them new to it, are compared, and those closer than what
a node has are its new neighbours. Rounds end when hardly any entry changes. A node meets at most a fixed number of hubs in a
round, however many point at it, and hubs see one byte a component; ids move with their codes, nothing is collected.

A search holds the best nodes met so far, steps in each round to all of them that it has not left yet, and ends when none is
left, by the codes. What it holds in the end is measured on the original vectors. Queries that are rows of the table start at
their own node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.tables import Workspace

#: Neighbours of a node, those of each kind that a hub gathers in each direction, and the best nodes that a search holds. With
#: vectors that fill 64 dimensions evenly, the hardest kind, 50,000 of them are found again at 0.97 or more.
DEGREE, GATHERED, HELD = 40, 16, 160
#: New neighbours that a hub offers to one of its members in a round; more may follow in the next.
OFFERED = 8
#: Nodes in a block of the first graph, and orders that are cut into blocks.
BLOCK, ORDERS = 256, 3
#: Rounds end when a smaller share of the entries is new, or after so many.
SETTLED, MOST_ROUNDS = 0.01, 10
#: Vectors that the trees are fitted on; they come to the driver. A leaf holds some 8 of them.
SAMPLED = 8192
_HUBS_AT_ONCE = 256


def usable_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``row, vec_id, vector``: rows whose vector is neither null nor zero nor holds a null or a non-finite component.

    Of vectors of several lengths only those of the most frequent one (of equals, the longest) take part.
    """
    kept = "array<double>" if dict(df.dtypes)[vector] == "array<double>" else "array<float>"
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast(kept).alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vector").isNotNull()).where(F.coalesce(finite, F.lit(False))).where(F.exists("vector", lambda x: x != 0))
    usual = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (usual["n"] if usual else 0))


def matrix_of(column: pa.Array, rows: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 1)


def _codes(vectors: np.ndarray) -> np.ndarray:
    """Each vector as its scale (8 bytes) and one byte a component."""
    scale = np.abs(vectors).max(axis=1) / 127
    scale[scale == 0] = np.finfo(np.float64).tiny
    parts = np.rint(vectors / scale[:, None]).astype(np.int8).view(np.uint8)
    return np.hstack([scale.astype("<f8").view(np.uint8).reshape(-1, 8), parts])


class _Coded:
    """Codes of many vectors; distances come from whole numbers, so each pair has one distance wherever it is measured."""

    def __init__(self, codes: list[bytes]):
        raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
        self.scale = np.ascontiguousarray(raw[:, :8]).view("<f8").ravel()
        self.parts = raw[:, 8:].view(np.int8).astype(np.float64)
        self.square = (self.parts * self.parts).sum(axis=1) * (self.scale * self.scale)


def _squares(parts: np.ndarray, scale: np.ndarray, square: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, over the last two axes."""
    dots = parts @ np.swapaxes(parts, -1, -2)
    both = scale[..., :, None] * scale[..., None, :]
    return np.maximum(square[..., :, None] + square[..., None, :] - 2 * both * dots, 0)


# --- the first graph -----------------------------------------------------------------


def fit_tree(sample: np.ndarray, draw: np.random.Generator, leaf: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Directions and thresholds of a complete tree in heap order: each node parts its vectors at the median of a direction."""
    depth = max(0, int(np.log2(max(len(sample), 1) / leaf)))
    directions, thresholds = np.zeros((1 << depth, sample.shape[1])), np.zeros(1 << depth)
    at = np.ones(len(sample), np.int64)
    for level in range(depth):
        for node in range(1 << level, 2 << level):
            own = sample[at == node]
            if len(own) > 1:
                one, other = draw.choice(len(own), 2, replace=False)
                directions[node] = own[one] - own[other]
                thresholds[node] = np.median(own @ directions[node])
        at = _step(sample, at, directions, thresholds)
    return directions, thresholds


def _step(vectors: np.ndarray, at: np.ndarray, directions: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    return 2 * at + (np.einsum("ij,ij->i", vectors, directions[at]) > thresholds[at])


def _leaves(vectors: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    at = np.ones(len(vectors), np.int64)
    for _ in range(len(tree[0]).bit_length() - 1):
        at = _step(vectors, at, *tree)
    return at


_NEAR = "array<struct<dist:float,nbr:bigint>>"
_NEAR_TYPE = pa.struct([("dist", pa.float32()), ("nbr", pa.int64())])


def _near_lists(nodes: np.ndarray, nbrs: np.ndarray, dists: np.ndarray, most: int) -> pa.RecordBatch:
    """``node, near``: each node's closest, ordered by distance and number."""
    order = np.lexsort((nbrs, dists, nodes))
    nodes, nbrs, dists = nodes[order], nbrs[order], dists[order]
    fresh = np.ones(len(nodes), bool)
    fresh[1:] = (nodes[1:] != nodes[:-1]) | (nbrs[1:] != nbrs[:-1])
    nodes, nbrs, dists = nodes[fresh], nbrs[fresh], dists[fresh]
    firsts = np.flatnonzero(np.diff(nodes, prepend=nodes[0] - 1 if len(nodes) else 0))
    sizes = np.diff(np.append(firsts, len(nodes)))
    kept = np.arange(len(nodes)) - np.repeat(firsts, sizes) < most
    ends = np.concatenate([[0], np.cumsum(np.minimum(sizes, most))]).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(dists[kept].astype(np.float32)), pa.array(nbrs[kept])], fields=list(_NEAR_TYPE))
    return pa.RecordBatch.from_arrays([pa.array(nodes[firsts]), pa.ListArray.from_arrays(pa.array(ends), values)], ["node", "near"])


def _block_lists(ordered: DataFrame, block: int, degree: int) -> DataFrame:
    """``node, near`` inside blocks of rows that follow each other in a task."""

    def of(nodes: list[int], codes: list[bytes]) -> pa.RecordBatch:
        own, number = _Coded(codes), np.array(nodes, np.int64)
        squares = _squares(own.parts, own.scale, own.square)
        np.fill_diagonal(squares, np.inf)
        most = min(degree, len(nodes) - 1)
        best = np.argpartition(squares, most - 1, axis=1)[:, :most] if most else np.empty((len(nodes), 0), np.int64)
        rows = np.repeat(np.arange(len(nodes)), most)
        return _near_lists(number[rows], number[best.ravel()], np.sqrt(squares[rows, best.ravel()]), degree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[int] = []
        codes: list[bytes] = []
        for batch in batches:
            nodes += batch.column("node").to_pylist()
            codes += batch.column("code").to_pylist()
            while len(nodes) >= 2 * block:  # what is left last makes a block between one and two times that size
                yield of(nodes[:block], codes[:block])
                nodes, codes = nodes[block:], codes[block:]
        if nodes:
            yield of(nodes, codes)

    return ordered.select("node", "code").mapInArrow(run, f"node bigint, near {_NEAR}")


def _with_places(nodes: DataFrame, sample: np.ndarray, orders: int, seed: int) -> DataFrame:
    """``node, code`` and, per order, the leaf of each vector in a tree of its own."""
    draw = np.random.Generator(np.random.PCG64(seed))
    trees = [fit_tree(sample, draw) for _ in range(orders)]
    sent = nodes.sparkSession.sparkContext.broadcast(trees)
    names = [f"leaf_{i}" for i in range(orders)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = matrix_of(batch.column("vector"), batch.num_rows)
                codes = [row.tobytes() for row in _codes(vectors)]
                leaves = [pa.array(_leaves(vectors, tree)) for tree in sent.value]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(codes, pa.binary()), *leaves], ["node", "code", *names])

    schema = "node bigint, code binary, " + ", ".join(f"{n} bigint" for n in names)
    return nodes.select("node", "vector").mapInArrow(run, schema)


# --- neighbours of neighbours --------------------------------------------------------


def _gathered(graph: DataFrame, gathered: int, turn: int) -> DataFrame:
    """``hub, member, fresh, code, worst``: what each hub sees in this round.

    A node offers its ``gathered`` closest new and old neighbours; of those that point at a node, as many of each kind
    are taken by a hash, so a node that very many point at is in few lists.
    """
    def some(fresh: bool) -> Column:
        chosen = F.filter("near", lambda x: x["fresh"] if fresh else ~x["fresh"])
        return F.slice(F.transform(chosen, lambda x: F.struct(x["nbr"].alias("nbr"), F.lit(fresh).alias("fresh"))), 1, gathered)

    offered = graph.select("node", "code", "worst", F.inline(F.concat(some(True), some(False))))
    place = F.row_number().over(Window.partitionBy("nbr", "fresh").orderBy(F.xxhash64("node", "nbr", F.lit(turn)), "node"))
    taken = offered.withColumn("place", place).where(F.col("place") <= gathered).drop("place")
    ends = graph.select(F.col("node").alias("nbr"), F.col("code").alias("nbr_code"), F.col("worst").alias("nbr_worst"))
    both = taken.join(ends, "nbr").select(
        F.inline(
            F.array(
                F.struct(F.col("node").alias("hub"), F.col("nbr").alias("member"), "fresh", F.col("nbr_code").alias("code"), F.col("nbr_worst").alias("worst")),
                F.struct(F.col("nbr").alias("hub"), F.col("node").alias("member"), "fresh", "code", "worst"),
            )
        )
    )
    return both.repartition("hub").sortWithinPartitions("hub")


def _met(lists: DataFrame, degree: int) -> DataFrame:
    """``node, near``: members of one hub that are closer than what they have."""

    def of(hubs: np.ndarray, members: np.ndarray, fresh: np.ndarray, codes: list[bytes], worst: np.ndarray) -> pa.RecordBatch | None:
        own = _Coded(codes)
        firsts = np.flatnonzero(np.diff(hubs, prepend=hubs[0] - 1))
        sizes = np.diff(np.append(firsts, len(hubs)))
        wide = int(sizes.max())
        place = np.where(np.arange(wide) < sizes[:, None], firsts[:, None] + np.arange(wide), -1)
        squares = _squares(own.parts[place], own.scale[place], own.square[place])
        number, new = np.where(place < 0, -1, members[place]), fresh[place]
        usable = (number[:, :, None] != number[:, None, :]) & (number >= 0)[:, :, None] & (number >= 0)[:, None, :]
        usable &= new[:, :, None] | new[:, None, :]
        squares = np.where(usable & (np.sqrt(squares).astype(np.float32) < worst[place][:, :, None]), squares, np.inf)
        most = min(OFFERED, wide)
        best = np.argpartition(squares, most - 1, axis=2)[:, :, :most]
        closest = np.take_along_axis(squares, best, 2)
        at, one, rank = np.nonzero(np.isfinite(closest))
        if not len(at):
            return None
        return _near_lists(number[at, one], number[at, best[at, one, rank]], np.sqrt(closest[at, one, rank]), degree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None

        def portions(batch: pa.RecordBatch, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal rest
            hubs = batch.column("hub").to_numpy()
            firsts = np.flatnonzero(np.diff(hubs, prepend=hubs[0] - 1))
            ends = [*firsts[_HUBS_AT_ONCE::_HUBS_AT_ONCE].tolist(), *([] if last else [int(firsts[-1])])]
            begin = 0
            for end in sorted({*ends, *([batch.num_rows] if last else [])}):
                part = batch.slice(begin, end - begin)
                begin = end
                if part.num_rows:
                    out = of(
                        *[part.column(c).to_numpy(zero_copy_only=False) for c in ("hub", "member", "fresh")],
                        part.column("code").to_pylist(), part.column("worst").to_numpy(),
                    )
                    if out is not None:
                        yield out
            rest = batch.slice(begin) if begin < batch.num_rows else None

        for batch in batches:
            if batch.num_rows:
                joined = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
                yield from portions(joined, False)
        if rest is not None:
            yield from portions(rest, True)

    return lists.select("hub", "member", "fresh", "code", "worst").mapInArrow(run, f"node bigint, near {_NEAR}")


def _tagged(near: Column, fresh: Column) -> Column:
    return F.transform(near, lambda x: F.struct(x["dist"].alias("dist"), x["nbr"].alias("nbr"), fresh.alias("fresh")))


def _worst(degree: int) -> Column:
    """The distance that a new neighbour must stay below."""
    full = F.size("near") >= degree
    return F.when(full, F.element_at("near", -1)["dist"]).otherwise(F.lit(float("inf"))).cast("float").alias("worst")


def _grown(graph: DataFrame, found: DataFrame, degree: int, gathered: int) -> DataFrame:
    """The graph with what was found; entries that a hub has seen are old from now on."""
    offers = found.groupBy("node").agg(F.flatten(F.collect_list("near")).alias("offers"))
    none = F.array().cast(_NEAR)
    plain = F.transform("near", lambda x: F.struct(x["dist"].alias("dist"), x["nbr"].alias("nbr")))
    new = F.array_except(F.coalesce("offers", none), plain)
    seen = F.transform(
        "near", lambda x, i: F.struct(
            x["dist"].alias("dist"), x["nbr"].alias("nbr"),
            (x["fresh"] & (F.size(F.filter(F.slice("near", 1, i), lambda y: y["fresh"])) >= gathered)).alias("fresh"),
        )
    )
    near = F.slice(F.array_sort(F.concat(seen, _tagged(new, F.lit(True)))), 1, degree)
    return graph.join(offers, "node", "left").select("node", "code", near.alias("near")).select("*", _worst(degree))


def neighbour_graph(
    nodes: DataFrame, ws: Workspace, degree: int = DEGREE, gathered: int = GATHERED, block: int = BLOCK,
    orders: int = ORDERS, settled: float = SETTLED, most_rounds: int = MOST_ROUNDS, sampled: int = SAMPLED, seed: int = 77,
) -> DataFrame:
    """``node, code, near, worst`` for ``node, vector``: each node's ``degree`` closest found, closest first."""
    chosen = nodes.orderBy(F.xxhash64("node"), "node").limit(sampled).select("vector").toArrow()
    sample = matrix_of(chosen.column("vector").combine_chunks(), chosen.num_rows)
    placed = ws.stage(_with_places(nodes, sample, orders, seed), "placed")
    lists = None
    for i in range(orders):
        leaf = f"leaf_{i}"
        mixed = F.xxhash64("node", F.lit(i))  # parts a leaf that outgrew the sample's shape
        ordered = placed.select("node", "code", leaf).repartitionByRange(leaf, mixed).sortWithinPartitions(leaf, mixed)
        part = ws.stage(_block_lists(ordered, block, degree), f"lists-{i}")
        lists = part if lists is None else lists.union(part)
    closest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, degree)
    begun = placed.select("node", "code").join(lists.groupBy("node").agg(closest.alias("near")), "node", "left")
    near = _tagged(F.coalesce("near", F.array().cast(_NEAR)), F.lit(True))
    graph = ws.stage(begun.select("node", "code", near.alias("near")).select("*", _worst(degree)), "graph-0")
    ws.drop("placed", *[f"lists-{i}" for i in range(orders)])
    for turn in range(most_rounds):
        found = _met(_gathered(graph, gathered, turn), degree)
        after = ws.stage(_grown(graph, found, degree, gathered), f"graph-{turn + 1}")
        ws.drop(f"graph-{turn}")
        graph = after
        fresh, entries = graph.agg(
            F.sum(F.size(F.filter("near", lambda x: x["fresh"]))), F.sum(F.size("near"))
        ).first()
        if not entries or fresh <= settled * entries:
            break
    return graph


# --- search --------------------------------------------------------------------------

def _steps(graph: DataFrame, degree: int) -> DataFrame:
    """``node, ways``: a node's neighbours and as many of those that have it as a neighbour."""
    out = graph.select("node", F.explode("near.nbr").alias("nbr"))
    back = F.row_number().over(Window.partitionBy("nbr").orderBy(F.xxhash64("node", "nbr"), "node"))
    into = out.withColumn("place", back).where(F.col("place") <= degree).select(F.col("nbr").alias("node"), F.col("node").alias("nbr"))
    return out.union(into).groupBy("node").agg(F.collect_set("nbr").alias("ways"))


_STATE = "query bigint, code binary, best array<bigint>, dists array<double>, open array<bigint>, seen array<bigint>"


def _looked(state: DataFrame, held: int) -> DataFrame:
    """The state after measuring ``found``, the new nodes of each query: the best ``held`` and those of them not left yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            columns = [batch.column(c) for c in ("query", "code", "best", "dists", "seen", "found")]
            for query, code, best, dists, seen, found in zip(*columns, strict=True):
                nodes = np.array(best.as_py() or [], np.int64)
                near, new = np.array(dists.as_py() or []), np.empty(0, np.int64)
                if found.is_valid and len(found.values):
                    new = found.values.field("node").to_numpy()
                    own = _Coded([code.as_py(), *found.values.field("code").to_pylist()])
                    dots = own.parts[1:] @ own.parts[0]
                    squares = own.square[1:] + own.square[0] - 2 * own.scale[1:] * own.scale[0] * dots
                    nodes, near = np.concatenate([nodes, new]), np.concatenate([near, np.sqrt(np.maximum(squares, 0))])
                order = np.lexsort((nodes, near))[:held]
                nodes, near = nodes[order], near[order]
                seen = np.concatenate([np.array(seen.as_py() or [], np.int64), new])
                rows.append((query.as_py(), code.as_py(), nodes, near, nodes[np.isin(nodes, new)], seen))
            names = ("query", "code", "best", "dists", "open", "seen")
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            arrays = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return state.select("query", "code", "best", "dists", "seen", "found").mapInArrow(run, _STATE)


def _found(reached: DataFrame, graph: DataFrame) -> DataFrame:
    """``query, found``: the nodes of ``query, node`` with their codes."""
    coded = reached.join(graph.select("node", "code"), "node")
    return coded.groupBy("query").agg(F.collect_list(F.struct("node", "code")).alias("found"))


def greedy_search(starts: DataFrame, graph: DataFrame, ws: Workspace, held: int = HELD, degree: int = DEGREE) -> DataFrame:
    """``query, node``: the ``held`` closest nodes that each query of ``query, code, node`` meets from ``node`` on, by codes.

    A query may start at several nodes. It ends when it has stepped to all that it holds.
    """
    ways = ws.stage(_steps(graph, degree), "ways")
    none = [F.lit(None).cast(t).alias(n) for n, t in (("best", "array<bigint>"), ("dists", "array<double>"), ("seen", "array<bigint>"))]
    asked = starts.groupBy("query").agg(F.first("code").alias("code"))
    first = asked.select("query", "code", *none).join(_found(starts.select("query", "node").distinct(), graph), "query")
    state, turn = ws.stage(_looked(first, held), "search-0"), 0
    while not state.where(F.size("open") > 0).isEmpty():
        ahead = state.select("query", F.explode("open").alias("node")).join(ways, "node")
        reached = ahead.select("query", F.explode("ways").alias("node")).groupBy("query").agg(F.collect_set("node").alias("reached"))
        new = reached.join(state.select("query", "seen"), "query").select(
            "query", F.explode(F.array_except("reached", "seen")).alias("node")
        )
        turn += 1
        after = ws.stage(_looked(state.join(_found(new, graph), "query", "left"), held), f"search-{turn}")
        ws.drop(f"search-{turn - 1}")
        state = after
    return state.select("query", F.explode("best").alias("node"))


def _measured(rows: DataFrame) -> DataFrame:
    """``query, node, dist`` of ``query, query_vector, node, vector``: in double precision, on the original vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                gap = matrix_of(part.column("query_vector"), part.num_rows) - matrix_of(part.column("vector"), part.num_rows)
                dist = np.sqrt((gap * gap).sum(axis=1))
                yield pa.RecordBatch.from_arrays([part.column("query"), part.column("node"), pa.array(dist)], ["query", "node", "dist"])

    return rows.select("query", "query_vector", "node", "vector").mapInArrow(run, "query bigint, node bigint, dist double")


def nearest_neighbours(
    df: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", held: int = HELD, **graph_options
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows that ``is_query`` picks by ``vec_id``: their ``k`` nearest other rows.

    Rows without a usable vector (see ``usable_vectors``) take no part, neither as query nor as neighbour. Rows may share an id:
    each is a query of its own and a neighbour of the others. A null id can be a neighbour, behind all others at the same
    distance, but no query. Fewer rows than ``k`` give all there are; an empty table gives none.
    """
    ws = Workspace(df.sparkSession, "neighbours")
    rows = ws.stage(usable_vectors(df, key, vector), "rows")
    # Of equal vectors the k + 1 smallest ids stay, so that k are left beside the query's own; each task keeps its own first ones.
    same = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    place, head = F.row_number().over(same), F.first("row").over(same.rowsBetween(Window.unboundedPreceding, 0))
    members = ws.stage(rows.withColumns({"place": place, "node": head}).where(F.col("place") <= k + 1), "members")
    nodes = ws.stage(members.where("place = 1").select("node", "vector"), "nodes")
    graph = neighbour_graph(nodes, ws, **graph_options)
    asked = ws.stage(
        rows.where(is_query & F.col("vec_id").isNotNull()).join(nodes, "vector").select(F.col("row").alias("query"), "vec_id", "vector", "node"),
        "queries",
    )
    starts = asked.join(graph.select("node", "code"), "node").select("query", "code", "node")
    found = ws.stage(greedy_search(starts, graph, ws, held, graph_options.get("degree", DEGREE)), "found")
    pairs = found.join(nodes, "node").join(asked.select("query", F.col("vector").alias("query_vector")), "query")
    near = (
        _measured(pairs).join(members.select("node", "vec_id", "row"), "node").where("row <> query")
        .withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("dist", F.col("vec_id").asc_nulls_last(), "row")))
        .where(F.col("rank") <= k)
    )
    ids = asked.select("query", F.col("vec_id").alias("query_id"))
    return ws.finish(near.join(ids, "query").select("query_id", "rank", "vec_id", F.col("dist").alias("score")))
