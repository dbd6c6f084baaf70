"""Most similar vectors for every vector: NN-descent through Spark joins, and greedy search on the graph it builds.

Exact copies are collapsed to one vertex first. A first graph comes from random-projection trees whose cuts are fitted on a
bounded sample but which every vector passes; a leaf that holds more than its share is cut further into pieces along one more
random projection, so the pieces in which all are compared with all are of one size however many vectors there are. Then, in
rounds, each vertex receives the vectors of its neighbours and of the vertices it is a neighbour of, compares them with one
another and passes on what improves a vertex's list. Vertices that are neighbours of very many are met in buckets, each with
the vertex's own neighbours, and a list's best are ranked, not gathered, so no task holds an unbounded group and no link is
left out. Vectors travel once a link and round; similarities never leave numpy or the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Scratch

#: Vectors on which the cuts of the trees are fitted, at most.
SAMPLE = 20_000


def usable(embedding: Column, dim: int) -> Column:
    """dim finite values, not all zero."""
    fine = F.forall(embedding, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(embedding) == dim) & fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _unit(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)  # no overflow and no underflow of squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _vectors(s: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(s), dtype=np.float32).reshape(-1, dim)


class Trees:
    """Random-projection trees with cuts at sample medians; ``leaf`` numbers the leaf of each vector in each tree."""

    def __init__(self, sample: np.ndarray, leaves: int, trees: int, seed: int):
        rng = np.random.default_rng(seed)
        self.depth = max(0, int(np.ceil(np.log2(max(1, leaves)))))
        self.planes, self.cuts = [], []
        for _ in range(trees):
            node = np.zeros(len(sample), dtype=np.int64)
            planes, cuts = [], []
            for level in range(self.depth):
                w = rng.standard_normal((1 << level, sample.shape[1])).astype(np.float32)
                # the direction between two random members of a node separates better than a random one
                for k in range(1 << level):
                    members = np.flatnonzero(node == k)
                    if len(members) > 1:
                        a, b = rng.choice(members, 2, replace=False)
                        w[k] = sample[a] - sample[b]
                at = np.einsum("nd,nd->n", sample, w[node])
                c = np.zeros(1 << level, dtype=np.float32)
                order = np.argsort(node, kind="stable")
                bounds = np.searchsorted(node[order], np.arange((1 << level) + 1))
                for k in range(1 << level):
                    if bounds[k + 1] > bounds[k]:
                        c[k] = np.median(at[order[bounds[k] : bounds[k + 1]]])
                planes.append(w)
                cuts.append(c)
                node = 2 * node + (at > c[node])
            self.planes.append(planes)
            self.cuts.append(cuts)

    def leaf(self, m: np.ndarray) -> np.ndarray:
        out = np.zeros((len(m), len(self.planes)), dtype=np.int64)
        for t, (planes, cuts) in enumerate(zip(self.planes, self.cuts)):
            node = np.zeros(len(m), dtype=np.int64)
            for w, c in zip(planes, cuts):
                node = 2 * node + (np.einsum("nd,nd->n", m, w[node]) > c[node])
            out[:, t] = node
        return out


def _groups(parts: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames that end where a group ends, from batches of rows sorted by the keys."""
    rest = None
    for pdf in parts:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        last = (pdf[keys] == pdf[keys].iloc[-1]).all(axis=1).to_numpy()
        first = len(pdf) - int(last[::-1].argmin() if not last.all() else len(pdf))
        if first:
            yield pdf.iloc[:first]
        rest = pdf.iloc[first:]
    if rest is not None and len(rest):
        yield rest


def _pieces(parts: Iterator[pd.DataFrame], keys: list[str], most: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by the keys as frames of one group each, of less than two times ``most`` rows; what is held is one piece."""
    rest = None
    for pdf in parts:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        key = pdf[keys].to_numpy()
        starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(pdf)]
        for a, b in zip(starts, starts[1:]):
            while b - a >= 2 * most:
                yield pdf.iloc[a : a + most]
                a += most
            if b == len(pdf):
                rest = pdf.iloc[a:b]
            elif b > a:
                yield pdf.iloc[a:b]
    if rest is not None and len(rest):
        yield rest


def _top(links: DataFrame, k: int) -> DataFrame:
    """``u, nbrs``: the k best links ``u, v, sim, fresh`` of a vertex, each neighbour once, as (v, sim, fresh).

    Links are ranked by (similarity, neighbour), so a link met several times has one rank, and those beyond the k-th are dropped before
    and after the shuffle; only k neighbours of a vertex are ever listed. What is known comes before what is fresh.
    """
    w = W.partitionBy("u").orderBy(F.desc("sim"), "v")
    best = links.withColumn("r", F.dense_rank().over(w)).where(F.col("r") <= k).groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("d"), "v", "fresh")))
    return best.groupBy("u").agg(F.transform(F.slice(listed, 1, k), lambda x: F.struct(x["v"].alias("v"), (-x["d"]).alias("sim"), x["fresh"].alias("fresh"))).alias("nbrs"))


_LINK = "u bigint, v bigint, sim float, fresh boolean"


def _best(u: np.ndarray, v: np.ndarray, sim: np.ndarray, k: int) -> pd.DataFrame:
    """The k best (v, sim) of each u, as links; similarities are rounded, so that one link has one."""
    order = np.lexsort((v, -sim, u))
    u, v, sim = u[order], v[order], np.round(sim[order].astype(np.float64), 5).astype(np.float32)
    keep = np.ones(len(u), bool)
    keep[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    u, v, sim = u[keep], v[keep], sim[keep]
    first = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1]))) if len(u) else np.zeros(0, np.int64)
    rank = np.arange(len(u)) - np.repeat(first, np.diff(np.append(first, len(u))))
    u, v, sim = u[rank < k], v[rank < k], sim[rank < k]
    return pd.DataFrame({"u": u, "v": v, "sim": sim, "fresh": np.ones(len(u), bool)})


def build_graph(vertices: DataFrame, scratch: Scratch, dim: int, k: int = 16, trees: int = 4, leaf: int = 250, rounds: int = 6, bucket: int = 32, enough: float = 0.002, seed: int = 5) -> tuple[DataFrame, Trees]:
    """``u, nbrs``: of each vertex (``u BIGINT, vec BINARY``, unit float32) about the k most similar others; and the trees."""
    spark = vertices.sparkSession
    n = vertices.count()
    # by a hash of the vertex, so every part of the table is in it alike; its size is SAMPLE on average, and cut to it
    chance = F.pmod(F.xxhash64("u", F.lit(seed)), F.lit(1 << 40)) < int((1 << 40) * min(1.0, SAMPLE / max(1, n)))
    sample = [r["vec"] for r in vertices.where(chance).select("vec").collect()][:SAMPLE]
    m = np.frombuffer(b"".join(sample), dtype=np.float32).reshape(-1, dim) if sample else np.zeros((0, dim), np.float32)
    # a node of the tree keeps at least 8 sample vectors, so that its cut means something
    forest = spark.sparkContext.broadcast(Trees(m, min(-(-n // leaf), max(1, len(m) // 8)), trees, seed))
    along = np.random.default_rng(seed + 1).standard_normal((trees, dim)).astype(np.float32)

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            x = _vectors(pdf["vec"], dim)
            at = forest.value.leaf(x)
            for t in range(at.shape[1]):
                yield pd.DataFrame({"tree": t, "leaf": at[:, t], "along": x @ along[t], "u": pdf["u"], "vec": pdf["vec"]})

    def inside(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _pieces(parts, ["tree", "leaf", "part"], leaf):
            x, ids = _vectors(g["vec"], dim), g["u"].to_numpy()
            s = x @ x.T
            np.fill_diagonal(s, -2)
            w = min(k, len(x) - 1)
            if w > 0:
                at = np.argpartition(-s, w - 1, axis=1)[:, :w]
                yield _best(np.repeat(ids, w), ids[at].ravel(), np.take_along_axis(s, at, 1).ravel(), k)

    placed = vertices.mapInPandas(place, "tree int, leaf bigint, along float, u bigint, vec binary")
    if n > 2 * leaf << forest.value.depth:
        # the sample allows no more leaves: crowded ones are dealt to parts along the projection, by where a normal
        # distribution of the leaf's mean and spread has its quantiles; pieces are cut to size in any case
        shape = placed.groupBy("tree", "leaf").agg(F.count("*").alias("c"), F.avg("along").alias("m"), F.stddev_pop("along").alias("d"))
        z = (F.col("along") - F.col("m")) / F.greatest(F.col("d"), F.lit(1e-9))
        parts = F.ceil(F.col("c") / (4 * leaf))
        part = F.floor(parts / (1 + F.exp(-1.702 * z))).cast("int")
        parted = placed.join(F.broadcast(shape), ["tree", "leaf"]).withColumn("part", part).drop("c", "m", "d")  # a row a leaf, 10,000 at most
    else:
        parted = placed.withColumn("part", F.lit(0))
    first = parted.repartition("tree", "leaf", "part").sortWithinPartitions("tree", "leaf", "part", "along").select("tree", "leaf", "part", "u", "vec").mapInPandas(inside, _LINK)
    graph = scratch.cut(_top(first, k))

    def meet(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _groups(rows, ["u", "b"]):
            key = pdf[["u", "b"]].to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            sizes = np.diff(np.append(starts, len(pdf)))
            x, ids = _vectors(pdf["vec"], dim), pdf["v"].to_numpy()
            kth, fresh = pdf["kth"].to_numpy(dtype=np.float32), pdf["fresh"].to_numpy(dtype=bool)
            out_u, out_v, out_s = [], [], []
            for w in np.unique(sizes):
                if w < 2:
                    continue
                at = starts[sizes == w][:, None] + np.arange(w)
                for c in range(0, len(at), max(1, 200_000 // (w * w))):
                    i = at[c : c + max(1, 200_000 // (w * w))]
                    s = np.matmul(x[i], x[i].transpose(0, 2, 1))
                    met = (fresh[i][:, :, None] | fresh[i][:, None, :]) & (ids[i][:, :, None] != ids[i][:, None, :])
                    g, a, b = np.nonzero(met & (s > kth[i][:, :, None]))
                    out_u.append(ids[i[g, a]])
                    out_v.append(ids[i[g, b]])
                    out_s.append(s[g, a, b])
            if out_u:
                yield _best(np.concatenate(out_u), np.concatenate(out_v), np.concatenate(out_s), k)

    for _ in range(rounds):
        kth = F.when(F.size("nbrs") < k, F.lit(-2.0)).otherwise(F.element_at("nbrs", -1)["sim"]).cast("float")
        node = vertices.join(graph.select("u", kth.alias("kth")), "u", "left").select(F.col("u").alias("v"), "vec", F.coalesce("kth", F.lit(-2.0).cast("float")).alias("kth"))
        links = graph.select("u", F.explode("nbrs").alias("x")).select("u", F.col("x.v").alias("v"), F.col("x.fresh").alias("fresh"))
        back = links.select(F.col("v").alias("u"), F.col("u").alias("v"), "fresh")
        parts = back.groupBy("u").agg(F.ceil(F.count("*") / bucket).cast("int").alias("parts"))
        forward = links.join(parts, "u", "left").select("u", "v", "fresh", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("b"))
        behind = back.join(parts, "u").select("u", "v", "fresh", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("b"))
        sent = forward.union(behind).join(node, "v")
        better = sent.repartition("u", "b").sortWithinPartitions("u", "b").mapInPandas(meet, _LINK)
        old = graph.select("u", F.explode("nbrs").alias("x")).select("u", "x.v", "x.sim", F.lit(False).alias("fresh"))
        after = scratch.cut(_top(old.union(better), k))
        scratch.drop(graph)
        graph = after
        changed = graph.agg(F.sum(F.size(F.filter("nbrs", lambda x: x["fresh"]))).alias("c")).collect()[0]["c"] or 0
        if changed <= enough * n * k:
            break
    return graph, forest.value


class Collection:
    """Vectors with their copies collapsed: ``vertices`` (u, vec), ``members`` (u, node_id) and the graph over vertices."""

    def __init__(self, nodes: DataFrame, row_id: str = "node_id", embedding: str = "embedding", dim: int = 64, k: int = 16, **graph):
        self.spark, self.dim, self.k = nodes.sparkSession, dim, k
        self.scratch = Scratch(self.spark, "neighbors")

        def unit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                if len(pdf):
                    m = np.stack([np.asarray(x, dtype=np.float64) for x in pdf["e"]])
                    yield pd.DataFrame({"node_id": pdf["node_id"], "vec": [r.tobytes() for r in _unit(m).astype(np.float32)]})

        taken = nodes.where(usable(F.col(embedding), dim) & F.col(row_id).isNotNull())
        flat = taken.select(F.col(row_id).cast("bigint").alias("node_id"), F.col(embedding).alias("e")).mapInPandas(unit, "node_id bigint, vec binary")
        flat = self.scratch.cut(flat.withColumn("h", F.xxhash64("vec")).withColumn("g", F.xxhash64("vec", F.lit(1))))
        same = flat.groupBy("h", "g").agg(F.min("node_id").alias("u"))
        self.members = self.scratch.cut(flat.join(same, ["h", "g"]).select("u", "node_id").distinct())
        one = flat.groupBy("h", "g").agg(F.min(F.struct("node_id", "vec")).alias("x"))
        self.vertices = self.scratch.cut(one.select(F.col("x.node_id").alias("u"), "x.vec"))
        self.graph, self.trees = build_graph(self.vertices, self.scratch, dim, k, **graph)

    def pairs(self, least: float, top: int = 5) -> DataFrame:
        """``node_a, node_b, cosine``, node_a < node_b: pairs of at least this cosine of which one is among the other's
        ``top`` most similar nodes (equal cosines: smaller node_id first). Cosines are computed again in double precision."""
        links = self.graph.select("u", F.explode("nbrs").alias("x")).select("u", F.col("x.v").alias("v"), F.col("x.sim").alias("sim")).where(F.col("sim") >= least - 1e-3)
        vec_u, vec_v = self.vertices.select("u", F.col("vec").alias("a")), self.vertices.select(F.col("u").alias("v"), F.col("vec").alias("b"))
        dim = self.dim

        def exact(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                if len(pdf):
                    a, b = _vectors(pdf["a"], dim).astype(np.float64), _vectors(pdf["b"], dim).astype(np.float64)
                    c = (a * b).sum(1) / np.sqrt((a * a).sum(1) * (b * b).sum(1))
                    yield pd.DataFrame({"u": pdf["u"], "v": pdf["v"], "c": np.round(c, 9)})

        close = links.select("u", "v").join(vec_u, "u").join(vec_v, "v").mapInPandas(exact, "u bigint, v bigint, c double").where(F.col("c") >= least)
        w = W.partitionBy("u").orderBy("node_id")
        few = self.members.withColumn("r", F.row_number().over(w)).where(F.col("r") <= top + 1).drop("r")
        copies = few.join(few.groupBy("u").count().where("count > 1").select("u"), "u", "left_semi")
        others = close.join(few.withColumnRenamed("u", "v"), "v").select("u", "node_id", "c")
        near = copies.select("u", "node_id", F.lit(1.0).alias("c")).union(others)
        best = near.groupBy("u").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("c")).alias("d"), "node_id"))), 1, top + 1).alias("best"))
        each = self.members.join(best, "u").select(F.col("node_id").alias("n"), F.slice(F.filter("best", lambda x: x["node_id"] != F.col("node_id")), 1, top).alias("best"))
        long = each.select("n", F.explode("best").alias("x")).select(F.least("n", "x.node_id").alias("node_a"), F.greatest("n", "x.node_id").alias("node_b"), (-F.col("x.d")).alias("cosine"))
        return long.groupBy("node_a", "node_b").agg(F.max("cosine").alias("cosine"))


def similar_pairs(nodes: DataFrame, least: float = 0.9, top: int = 5, **options) -> DataFrame:
    """``node_a, node_b, cosine``: see ``Collection.pairs``. Rows with an unusable embedding or a null id take no part;
    repeated rows of one id count once; an empty table gives no rows."""
    return Collection(nodes, **options).pairs(least, top)


def search(collection: Collection, queries: DataFrame, k: int = 5, beam: int = 96, width: int = 96, entries: int = 64, trees: int = 4) -> DataFrame:
    """``node_id, neighbor, cosine, rank``: of each query (``node_id`` of a usable row) about its k most similar other nodes.

    Greedy search on the graph: a query starts at the best of ``entries`` vertices, taken by a hash, of its leaf in each of the
    trees, however many the leaf holds; then, hop by hop, the ``width`` best vertices of its beam that are not yet expanded
    show their neighbours, until none is left. All queries move at once, as joins with the graph and the vectors; each hop's
    state is a table in the shared folder.
    """
    scratch, dim = collection.scratch, collection.dim
    vertices, graph, members = collection.vertices, collection.graph, collection.members
    spark = vertices.sparkSession
    shared = spark.sparkContext.broadcast(collection.trees)
    asked = queries.select("node_id").join(members, "node_id").select("node_id", F.col("u").alias("q"))
    pool = "array<struct<d:double,v:bigint,seen:boolean>>"

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            at = shared.value.leaf(_vectors(pdf["vec"], dim))
            for t in range(min(trees, at.shape[1])):
                yield pd.DataFrame({"tree": t, "leaf": at[:, t], "v": pdf["v"], "vec": pdf["vec"]})

    def far(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            if len(pdf):
                yield pd.DataFrame({"q": pdf["q"], "v": pdf["v"], "d": -(_vectors(pdf["a"], dim).astype(float) * _vectors(pdf["b"], dim)).sum(1)})

    wanted = scratch.cut(asked.select("q").distinct().join(vertices.withColumnRenamed("u", "q"), "q"))
    placed = "tree int, leaf bigint, v bigint, vec binary"
    some = W.partitionBy("tree", "leaf").orderBy(F.xxhash64("v"), "v")
    there = vertices.withColumnRenamed("u", "v").mapInPandas(place, placed).withColumn("r", F.row_number().over(some)).where(F.col("r") <= entries).drop("r").withColumnRenamed("vec", "b")
    here = wanted.withColumnRenamed("q", "v").mapInPandas(place, placed).select("tree", "leaf", F.col("v").alias("q"), F.col("vec").alias("a"))
    first = here.join(there, ["tree", "leaf"]).where("q != v").mapInPandas(far, "q bigint, v bigint, d double").distinct()
    ranked = first.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy("d", "v"))).where(F.col("r") <= width)
    state = scratch.cut(wanted.select("q").join(ranked, "q", "left").groupBy("q").agg(F.array_sort(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("d", "v", F.lit(False).alias("seen"))))).cast(pool).alias("pool")))
    while True:
        chosen = state.select("q", "pool", F.slice(F.filter("pool", lambda x: ~x["seen"]), 1, width).alias("next"))
        steps = chosen.select("q", F.explode("next.v").alias("u")).join(graph, "u").select("q", F.explode("nbrs.v").alias("v")).distinct()
        fresh = steps.join(chosen.select("q", F.transform("pool", lambda x: x["v"]).alias("have")), "q").where(~F.array_contains("have", F.col("v"))).select("q", "v")
        met = fresh.join(vertices.select(F.col("u").alias("v"), F.col("vec").alias("b")), "v").join(wanted.select("q", F.col("vec").alias("a")), "q")
        found = met.mapInPandas(far, "q bigint, v bigint, d double").groupBy("q").agg(F.collect_list(F.struct("d", "v", F.lit(False).alias("seen"))).cast(pool).alias("more"))
        marked = F.transform("pool", lambda x: F.struct(x["d"].alias("d"), x["v"].alias("v"), (x["seen"] | F.array_contains(F.transform("next", lambda y: y["v"]), x["v"])).alias("seen")))
        joined = chosen.withColumn("pool", marked).join(found, "q", "left")
        after = scratch.cut(joined.select("q", F.slice(F.array_sort(F.concat("pool", F.coalesce("more", F.array().cast(pool)))), 1, beam).alias("pool")))
        scratch.drop(state)
        state = after
        if state.where(F.exists("pool", lambda x: ~x["seen"])).isEmpty():
            break
    few = members.withColumn("r", F.row_number().over(W.partitionBy("u").orderBy("node_id"))).where(F.col("r") <= k + 1).drop("r")
    near = state.select("q", F.explode("pool").alias("x")).where("x.v != q").select("q", F.col("x.v").alias("u"), F.col("x.d").alias("d")).union(wanted.select("q", F.col("q").alias("u"), F.lit(-1.0).alias("d")))
    best = near.join(few, "u").groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "node_id"))), 1, k + 1).alias("best"))
    each = asked.join(best, "q").select("node_id", F.posexplode(F.slice(F.filter("best", lambda x: x["node_id"] != F.col("node_id")), 1, k)).alias("i", "x"))
    return each.select("node_id", F.col("x.node_id").alias("neighbor"), F.round(-F.col("x.d"), 6).alias("cosine"), (F.col("i") + 1).cast("bigint").alias("rank"))


def nearest_exact(collection: Collection, queries: DataFrame, k: int = 5, block: int = 2000) -> DataFrame:
    """``node_id, neighbor, cosine, rank``: of each query its k most similar other nodes, by comparing it with every vector; to
    measure what the graph misses. Queries are compared in blocks that are broadcast, a scan of the vectors each."""
    dim, members, vertices = collection.dim, collection.members, collection.vertices
    spark = vertices.sparkSession
    asked = queries.select("node_id").distinct().join(members, "node_id").join(vertices, "u").select("node_id", "u", "vec")
    blocks = max(1, -(-asked.count() // block))
    found = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("node_id"), F.lit(blocks)) == b).collect()  # block queries on average
        if not rows:
            continue
        shared = spark.sparkContext.broadcast((np.array([r["node_id"] for r in rows]), np.frombuffer(b"".join(r["vec"] for r in rows), np.float32).reshape(-1, dim).astype(np.float64)))

        def compare(parts: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            ids, q = shared.value
            for pdf in parts:
                if not len(pdf):
                    continue
                s = np.round(q @ _vectors(pdf["vec"], dim).astype(np.float64).T, 9)
                w = min(k + 1, s.shape[1])
                at = np.argpartition(-s, w - 1, axis=1)[:, :w]
                yield pd.DataFrame({"q": np.repeat(ids, w), "u": pdf["u"].to_numpy()[at].ravel(), "c": np.take_along_axis(s, at, 1).ravel()})

        part = vertices.mapInPandas(compare, "q bigint, u bigint, c double")
        found = part if found is None else found.union(part)
    if found is None:
        return spark.createDataFrame([], "node_id bigint, neighbor bigint, cosine double, rank bigint")
    few = members.withColumn("r", F.row_number().over(W.partitionBy("u").orderBy("node_id"))).where(F.col("r") <= k + 1).drop("r")
    near = found.withColumn("r", F.dense_rank().over(W.partitionBy("q").orderBy(F.desc("c"), "u"))).where(F.col("r") <= k + 1).drop("r").join(few, "u").where("node_id != q")
    best = near.withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(F.desc("c"), "node_id")).cast("bigint")).where(F.col("rank") <= k)
    return best.select(F.col("q").alias("node_id"), F.col("node_id").alias("neighbor"), F.round("c", 6).alias("cosine"), "rank")
