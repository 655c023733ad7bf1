"""Approximate nearest neighbours by cosine: NN-descent for the graph, greedy search for the queries.

Equal vectors are one node. The first neighbours of a node come from blocks of a few sorted orders, by
signs of random projections. Each round then joins the graph with itself: at every node its neighbours and
a sample of the nodes it neighbours are compared with each other, if one of the two is new, and each keeps
the best it meets. A query starts at its own node and expands the best unvisited nodes of its beam until
none is left. Vectors travel as floats of length one and are compared in double, so that near copies keep
their order; the whole beam is then scored on the given vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemart.llm.base import query, table
from pagemart.session import discard, materialise

NEIGHBOURS, REVERSE, OFFERS = 30, 20, 10
ORDERS, BLOCK, ROUNDS = 4, 256, 8
BEAM, EXPAND, HOPS = 240, 40, 16
EDGE = pa.schema([("node", pa.int64()), ("nbr", pa.int64()), ("sim", pa.float64()), ("fresh", pa.bool_())])
EDGE_DDL = "node long, nbr long, sim double, fresh boolean"


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by their first column, cut anew so that equal values stay together."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        both = batch if rest is None else pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        keys = both.column(0).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield both.slice(0, cut)
        rest = both.slice(cut)
    if rest is not None:
        yield rest


def rows_of(column: pa.Array) -> np.ndarray:
    """A column of equally long number lists as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def stored(vectors: np.ndarray) -> list[bytes]:
    """Vectors of length one, as floats."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return [row.tobytes() for row in (scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))).astype(np.float32)]


def units_of(values: list[bytes]) -> np.ndarray:
    """Stored vectors as rows of length one, in double: cosines of near copies differ by less than a float holds."""
    rows = np.frombuffer(b"".join(values), np.float32).reshape(len(values), -1).astype(np.float64)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): distinct rows with an id and a vector of finite numbers, not all zero."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~odd & F.exists("vec", lambda x: x != 0))
    return rows.select("id", F.transform("vec", lambda x: x + F.lit(0.0)).alias("vec"))


def node_table(rows: DataFrame, members: int) -> DataFrame:
    """(node, vec, unit, members): one row per different vector, with its smallest ids."""
    first = Window.partitionBy("vec").orderBy("id")
    few = rows.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= members)
    grouped = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                units = pa.array(stored(rows_of(batch.column(1))), pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, units], names=["node", "vec", "members", "unit"])

    numbered = grouped.select(F.monotonically_increasing_id().alias("node"), "vec", "members")
    return numbered.mapInArrow(run, "node long, vec array<double>, members array<long>, unit binary")


def best(keys: np.ndarray, others: np.ndarray, sims: np.ndarray, known: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` best different others of each key; of equal pairs the known one stays."""
    order = np.lexsort((~known, others, keys))
    k, o = keys[order], others[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    order = order[new]
    order = order[np.lexsort((others[order], -sims[order], keys[order]))]
    k = keys[order]
    start = np.ones(len(k), bool)
    start[1:] = k[1:] != k[:-1]
    rank = np.arange(len(k)) - np.maximum.accumulate(np.where(start, np.arange(len(k)), 0))
    return order[rank < most]


def best_edges(edges: DataFrame, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches):
            node, nbr, sim, fresh = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield batch.take(pa.array(best(node, nbr, sim, ~fresh.astype(bool), most)))

    return edges.repartition("node").sortWithinPartitions("node").mapInArrow(run, EDGE_DDL)


def edge_batch(node: np.ndarray, nbr: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(node, pa.int64()), pa.array(nbr, pa.int64()), pa.array(sim, pa.float64()), pa.array(np.ones(len(node), bool))]
    return pa.RecordBatch.from_arrays(columns, schema=EDGE)


def first_edges(nodes: DataFrame, neighbours: int, orders: int, block: int) -> DataFrame:
    """The best neighbours inside blocks of rows that lie together in some orders by random projections."""

    def coded(seed: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    units = units_of(batch.column(1).to_pylist())
                    marks = units @ np.random.default_rng(seed).normal(size=(units.shape[1], 21))
                    code = (marks[:, :20] > 0) @ (1 << np.arange(19, -1, -1))
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(code.astype(np.int64)), pa.array(marks[:, 20])], names=["node", "unit", "code", "along"]
                    )

        return run

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for at in range(batch.num_rows):
                held.append((batch.column(0)[at].as_py(), batch.column(1)[at].as_py()))
                if len(held) == 2 * block:
                    yield from within(held[:block])
                    held = held[block:]
        yield from within(held)

    def within(held: list) -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            ids = np.array([h[0] for h in held])
            units = units_of([h[1] for h in held])
            sims = units @ units.T
            np.fill_diagonal(sims, -2)
            few = min(neighbours, len(held) - 1)
            near = np.argpartition(-sims, few - 1, axis=1)[:, :few]
            yield edge_batch(np.repeat(ids, few), ids[near].ravel(), np.take_along_axis(sims, near, axis=1).ravel())

    edges = None
    for seed in range(orders):
        rows = nodes.select("node", "unit").mapInArrow(coded(seed), "node long, unit binary, code long, along double")
        keys = ["code", "along", "node"]
        own = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("node", "unit").mapInArrow(compare, EDGE_DDL)
        edges = own if edges is None else edges.unionByName(own)
    return best_edges(edges, neighbours)


def joined_round(edges: DataFrame, nodes: DataFrame, seed: int, neighbours: int, reverse: int, offers: int) -> DataFrame:
    """One round: neighbours of the same node meet, and each node keeps its best."""
    around = edges.select(F.col("node").alias("center"), F.col("nbr").alias("member"), "fresh")
    # How many nodes one node neighbours is not bounded; the sample is taken before the shuffle, too.
    drawn = Window.partitionBy("center").orderBy(F.xxhash64("member", F.lit(seed)), "member")
    behind = edges.select(F.col("nbr").alias("center"), F.col("node").alias("member"), "fresh")
    behind = behind.withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= reverse).drop("n")
    worst = edges.groupBy("node").agg(F.when(F.count(F.lit(1)) >= neighbours, F.min("sim")).otherwise(F.lit(-2.0)).cast("double").alias("worst"))
    vectors = nodes.select("node", "unit").join(worst, "node").withColumnRenamed("node", "member")
    meeting = around.unionByName(behind).join(vectors, "member").select("center", "member", "fresh", "worst", "unit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches):
            center, member, fresh, worst = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            units, fresh = units_of(batch.column(4).to_pylist()), fresh.astype(bool)
            bounds = np.flatnonzero(np.diff(center, prepend=center[0] - 1, append=center[-1] + 1))
            found = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if b - a < 2 or not fresh[a:b].any():
                    continue
                sims = units[a:b] @ units[a:b].T
                own = member[a:b]
                sims[(own[:, None] == own[None, :]) | ~(fresh[a:b, None] | fresh[None, a:b])] = -2
                few = min(offers, b - a - 1)
                near = np.argpartition(-sims, few - 1, axis=1)[:, :few]
                marks = np.take_along_axis(sims, near, axis=1)
                row, place = np.nonzero(marks > worst[a:b, None])
                if len(row):
                    found.append((own[row], own[near[row, place]], marks[row, place]))
            if found:
                node, nbr, sim = (np.concatenate(c) for c in zip(*found, strict=True))
                kept = best(node, nbr, sim, np.zeros(len(node), bool), neighbours)
                yield edge_batch(node[kept], nbr[kept], sim[kept])

    offered = meeting.repartition("center").sortWithinPartitions("center").mapInArrow(run, EDGE_DDL)
    return best_edges(edges.withColumn("fresh", F.lit(False)).unionByName(offered), neighbours)


def neighbour_graph(
    nodes: DataFrame, neighbours: int = NEIGHBOURS, reverse: int = REVERSE, offers: int = OFFERS, orders: int = ORDERS,
    block: int = BLOCK, rounds: int = ROUNDS, settled: float = 0.02,
) -> DataFrame:
    """(node, nbr, sim, fresh): the graph, once under ``settled`` of its edges are new in a round or after ``rounds``."""
    edges = materialise(first_edges(nodes, neighbours, orders, block), "edges")
    for seed in range(rounds):
        former, edges = edges, materialise(joined_round(edges, nodes, seed, neighbours, reverse, offers), "edges")
        discard(former)
        count, new = edges.agg(F.count(F.lit(1)), F.sum(F.col("fresh").cast("long"))).first()
        if (new or 0) <= settled * count:
            break
    return edges


def searched(
    graph: DataFrame, nodes: DataFrame, starts: DataFrame, reverse: int = REVERSE, beam: int = BEAM, expand: int = EXPAND, hops: int = HOPS
) -> DataFrame:
    """(query, cand, sim): the beam of each query, from (query, unit, cand) to start at.

    A search ends when it has no unvisited node in its beam; ``hops`` only bounds the jobs.
    """
    drawn = Window.partitionBy("node").orderBy(F.desc("sim"), "nbr")
    back = graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "sim")
    back = back.withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= reverse)
    ways = graph.select("node", "nbr").unionByName(back.select("node", "nbr")).distinct().groupBy("node").agg(F.collect_list("nbr").alias("nbrs"))
    ways = materialise(ways.withColumnRenamed("node", "cand"), "ways")
    vectors = nodes.select(F.col("node").alias("cand"), "unit")
    row = lambda sim, seen, unit: ["query", "cand", sim.alias("sim"), seen.alias("seen"), unit.alias("unit")]
    none, nothing = F.lit(None).cast("binary"), F.lit(None).cast("double")
    own = starts.select("query", F.lit(-1).cast("long").alias("cand"), nothing.alias("sim"), F.lit(True).alias("seen"), "unit")
    state = starts.select("query", "cand", F.lit(1.0).alias("sim"), F.lit(False).alias("seen"), F.lit(True).alias("open"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches):
            q, cand, sim, seen = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            sim, seen = sim.astype(np.float64), seen.astype(bool)
            new = np.flatnonzero(batch.column(4).is_valid().to_numpy(zero_copy_only=False))
            units = units_of(batch.column(4).take(pa.array(new)).to_pylist())
            mine = cand[new] < 0  # the queries' own vectors: one for each query
            at = np.searchsorted(q[new][mine], q[new][~mine])
            sim[new[~mine]] = np.einsum("ij,ij->i", units[~mine], units[mine][at])
            q, cand, sim, seen = (c[cand >= 0] for c in (q, cand, sim, seen))
            kept = best(q, cand, sim, seen, beam)
            q, cand, sim, seen = q[kept], cand[kept], sim[kept], seen[kept]
            # Rows are in order of query and closeness: the first unvisited ones are expanded next.
            starts_at = np.flatnonzero(np.diff(q, prepend=q[0] - 1))
            before = np.cumsum(~seen) - ~seen
            place = before - np.repeat(before[starts_at], np.diff(np.append(starts_at, len(q))))
            columns = [q, cand, sim, seen, ~seen & (place < expand)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "cand", "sim", "seen", "open"])

    for _ in range(hops):
        ahead = state.where("open").join(ways, "cand").select("query", F.explode("nbrs").alias("cand")).distinct()
        ahead = ahead.join(state.select("query", "cand"), ["query", "cand"], "left_anti").join(vectors, "cand")
        rows = state.select(*row(F.col("sim"), F.col("seen") | F.col("open"), none)).unionByName(own)
        rows = rows.unionByName(ahead.select(*row(nothing, F.lit(False), F.col("unit"))))
        # A query's own vector comes first, then its beam.
        spread = rows.repartition("query").sortWithinPartitions("query", "cand")
        former, state = state, materialise(spread.mapInArrow(run, "query long, cand long, sim double, seen boolean, open boolean"), "beam")
        discard(former)
        if state.where("open").isEmpty():
            break
    return state.select("query", "cand", "sim")


#: A length that at most so many vectors have is searched by comparing each query with all of them.
FEW = 1000


def nearest(
    vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", few: int = FEW, **options
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` holds, the ``k`` nearest other rows found.

    ``score`` is the cosine in double precision on the given vectors; ties go to the smaller id. Rows with a null
    id, a null or empty vector, one of zeros alone, or one holding a null or a number that is not finite take
    no part. Vectors of different lengths are never near: each length has a graph of its own, and the lengths that at
    most ``few`` vectors have are compared in full. Rows repeated whole count once. A query's own id is never
    among its neighbours. With fewer rows than ``k`` all others are returned; an empty table gives no rows.
    ``options`` go to ``neighbour_graph``.
    """
    rows, asked = usable(vectors, id_col, vec_col), usable(vectors.where(is_query).select(id_col, vec_col), id_col, vec_col).distinct()
    width = F.size("vec")
    counts = materialise(rows.groupBy(width.alias("width")).count(), "lengths")
    # At most a length for every ``few`` rows.
    large = [r.width for r in counts.where(F.col("count") > few).collect()]
    small = counts.where(F.col("count") <= few).select("width")
    found = compared_in_full(asked.withColumn("width", width).join(small, "width"), rows.withColumn("width", width).join(small, "width"), k)
    for own in large:
        found = found.unionByName(searched_nearest(rows.where(width == own), asked.where(width == own), k, **options))
    return found


def compared_in_full(asked: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of all rows of a query's length, which are few."""
    asked = asked.select(F.col("id").alias("query_id"), "vec", "width").withColumn("query", F.monotonically_increasing_id())
    others = rows.select("width", F.col("id"), F.col("vec").alias("other")).distinct()
    pairs = materialise(asked, "few-queries").join(others, "width").where("id != query_id")
    return ranked(pairs.select("query", "query_id", F.array("id").alias("members"), "vec", "other"), k)


def searched_nearest(rows: DataFrame, asked: DataFrame, k: int, **options) -> DataFrame:
    """The ``k`` nearest found by the graph of these rows, which have one length."""
    nodes = materialise(node_table(rows, k + 1), "nodes")
    asked = asked.join(nodes.select("vec", F.col("node").alias("cand"), "unit"), "vec").select("id", "vec", "unit", "cand")
    asked = materialise(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    beam = searched(neighbour_graph(nodes, **options), nodes, asked.select("query", "unit", "cand"))
    pairs = beam.select("query", "cand").join(nodes.select(F.col("node").alias("cand"), F.col("vec").alias("other"), "members"), "cand")
    pairs = pairs.join(asked.select("query", F.col("id").alias("query_id"), "vec"), "query")
    return ranked(pairs.select("query", "query_id", "members", "vec", "other"), k)


def cosines(a: pa.Array, b: pa.Array) -> np.ndarray:
    """The cosine of each two vectors beside each other, which are of one length."""
    scores, lengths = np.zeros(len(a)), a.value_lengths().to_numpy(zero_copy_only=False)
    for own in np.unique(lengths):
        at = np.flatnonzero(lengths == own)
        x, y = (rows_of(column.take(pa.array(at))) for column in (a, b))
        x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
        scores[at] = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    return scores


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query from (query, query_id, members, vec, other), scored on the vectors as given."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = cosines(batch.column(3), batch.column(4))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scores)], names=["query", "query_id", "members", "score"])

    kind = dict(pairs.dtypes)["query_id"]
    scored = pairs.mapInArrow(score, f"query long, query_id {kind}, members array<{kind}>, score double")
    scored = scored.select("query", "query_id", F.explode("members").alias("vec_id"), "score").where("vec_id != query_id")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op3_nn_descent")
def op3_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
