"""Near-duplicate embeddings by hierarchical navigable small-world graphs.

Only vectors of one label are compared. Equal directions fold into one point first (with
how many vectors it stands for), so copies cost nothing. The points of a label are dealt
into shards; each shard's graph is built in one task and kept as a table. Layers are drawn
as usual; the links of a layer are built in bulk: the nearest points by matrix products,
of these the ones nearer to the point than to one picked before, and links back.

Every point then queries every shard of its label, in blocks that share one copy of the
graph. All queries of a step are searched at once: they descend the layers greedily (a point
of the shard itself starts at its own node) and search the lowest with a beam; whatever is
within reach is followed as well, so a large group widens the search by itself. For each
block and shard an audit compares a fixed share of the queries with the whole shard; as long
as one link is missed, the beam doubles and the block is searched again, up to a beam as
wide as the shard, which holds all its points. Found links are verified by cosine in double
precision. Links are counted where they are found, and of each block and shard only a forest
of them goes on to components, so a large group of near copies is never written as all its
pairs.

Rows: a vector that is null, zero, or holds a null or non-finite component, and one without
a label, links with nothing and is its own component; vectors of another length than the
query's link with nothing of it; repeated ids count as vectors of their own and share a
component's name by id; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calforge.llm.common import stored
from calforge.llm.components import components, relabel

SIMILAR = 0.93
SHARD_POINTS, BLOCK_POINTS = 16_384, 8_192
M, CANDIDATES, FIRST_BEAM, AUDIT_EVERY = 12, 48, 16, 20
#: Queries searched at once, and numbers of a gathered array held at once.
STEP, HELD = 256, 8 << 20
#: What a dot product in single precision may fall short of the one in double precision.
SLACK = 1e-4


class Graph:
    """A small-world graph over unit vectors ``x``. ``layers`` holds, from the lowest up, the
    points of a layer, their places in it, and their links (rows of point numbers, -1 for none)."""

    def __init__(self, x: np.ndarray, seed: int = 1):
        self.x, self.low = x, x.astype(np.float32)
        draws = np.random.default_rng(seed).random(len(x))
        level = np.minimum((-np.log(np.maximum(draws, 1e-12)) / np.log(M)).astype(int), 8)
        self.layers = []
        for layer in range(int(level.max(initial=0)) + 1):
            members = np.flatnonzero(level >= layer)
            place = np.full(len(x), -1)
            place[members] = np.arange(len(members))
            self.layers.append((place, _links(self.low[members], members)))
        self.entry = int(np.argmax(level))

    def _descend(self, q: np.ndarray) -> np.ndarray:
        """The point of the lowest layer where each query's search starts."""
        at = np.full(len(q), self.entry)
        for place, links in self.layers[:0:-1]:
            like, left = np.einsum("ij,ij->i", self.low[at], q), np.arange(len(q))
            while len(left):
                near = links[place[at[left]]]
                sims = np.where(near >= 0, np.einsum("ikj,ij->ik", self.low[near], q[left]), -2)
                best = sims.argmax(1)
                sims = sims[np.arange(len(left)), best]
                up = sims > like[left]
                left, near, best = left[up], near[up], best[up]
                at[left], like[left] = near[np.arange(len(left)), best], sims[up]
        return at

    def within(self, q: np.ndarray, own: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """``(query, point)`` of all links that the searches find; ``own`` is the query's own
        point in this graph, or -1. A beam as wide as the graph compares with all its points."""
        low, n = q.astype(np.float32), len(self.x)
        if beam >= n:
            return np.nonzero(q @ self.x.T >= SIMILAR)
        start = own.copy()
        start[own < 0] = self._descend(low[own < 0])
        links, reach = self.layers[0][1], SIMILAR - SLACK
        seen = np.zeros((len(q), n), bool)
        top = np.full((len(q), beam), -2, np.float32)
        qs, at = np.arange(len(q)), start
        seen[qs, at] = True
        top[:, 0] = np.einsum("ij,ij->i", self.low[at], low)
        hits = [(qs, at)]
        most = max(64, HELD // (links.shape[1] * q.shape[1]))
        while len(qs):
            now, node, qs, at = qs[:most], at[:most], qs[most:], at[most:]
            key = (now[:, None] * n + links[node])[links[node] >= 0]
            key = np.unique(key[~seen.reshape(-1)[key]])
            if not len(key):
                continue
            row, new = np.divmod(key, n)
            seen[row, new] = True
            sims = np.einsum("ij,ij->i", self.low[new], low[row])
            first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
            counts = np.diff(np.append(first, len(row)))
            fresh = np.full((len(first), int(counts.max())), -2, np.float32)
            fresh[np.repeat(np.arange(len(first)), counts), np.arange(len(row)) - np.repeat(first, counts)] = sims
            both = np.concatenate([top[row[first]], fresh], 1)
            top[row[first]] = np.partition(both, both.shape[1] - beam, 1)[:, -beam:]
            near = sims >= reach
            go = near | (sims >= top.min(1)[row])
            hits.append((row[near], new[near]))
            qs, at = np.concatenate([qs, row[go]]), np.concatenate([at, new[go]])
        row, node = (np.concatenate(v) for v in zip(*hits, strict=True))
        step = max(1, HELD // (2 * q.shape[1]))
        good = [np.einsum("ij,ij->i", self.x[node[a:a + step]], q[row[a:a + step]]) >= SIMILAR for a in range(0, len(row), step)]
        good = np.concatenate(good)
        return row[good], node[good]


def _links(y: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Links of the points ``members`` with vectors ``y``: at most M picked, then as many back."""
    n = len(y)
    k = min(CANDIDATES, n - 1)
    links = np.full((n, 2 * M), -1)
    if k < 1:
        return links
    picks, likes = np.full((n, M), -1), np.zeros((n, M), np.float32)
    for a in range(0, n, STEP):
        sims = y[a:a + STEP] @ y.T
        rows = np.arange(len(sims))[:, None]
        sims[rows[:, 0], a + rows[:, 0]] = -2
        near = np.argpartition(-sims, k - 1, 1)[:, :k]
        near = near[rows, np.argsort(-sims[rows, near], 1, kind="stable")]
        like = sims[rows, near]
        among = y[near] @ y[near].transpose(0, 2, 1)
        picked = np.zeros(near.shape, bool)
        for c in range(k):
            picked[:, c] = ~((among[:, c] > like[:, c, None]) & picked).any(1) & (picked.sum(1) < M)
        best = np.argsort(~picked, 1, kind="stable")[:, :M]        # the picked ones, then the nearest of the rest
        picks[a:a + STEP, :best.shape[1]], likes[a:a + STEP, :best.shape[1]] = near[rows, best], like[rows, best]
    links[:, :M] = picks
    src, dst, like = np.repeat(np.arange(n), M), picks.reshape(-1), likes.reshape(-1)
    back = dst >= 0
    back[back] = ~(picks[dst[back]] == src[back][:, None]).any(1)
    src, dst, like = src[back], dst[back], like[back]
    order = np.lexsort((-like, dst))
    src, dst = src[order], dst[order]
    rank = np.arange(len(dst)) - np.searchsorted(dst, dst)
    kept = rank < M
    links[dst[kept], M + rank[kept]] = src[kept]
    return np.where(links >= 0, members[links], -1)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links ``(a, b)``, as few as join the same points: each point with the smallest it reaches."""
    names, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = place[:len(a)], place[len(a):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while not np.array_equal(new, deeper := new[new]):
            new = deeper
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names[moved], names[root[moved]]


def _unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, np.float64) for r in rows]) if len(rows) else np.zeros((0, 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def points(embeddings: DataFrame) -> DataFrame:
    """Usable vectors, folded by label and direction: ``p, label, vec, copies``. Vectors that
    are equal component by component fold here; the fold saves work and changes no count."""
    v = F.col("embedding").cast("array<double>")
    usable = embeddings.select("label", v.alias("vec")).where("label is not null and vec is not null").where(
        (F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0))
    return usable.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("copies")) \
        .select(F.monotonically_increasing_id().alias("p"), "label", "vec", "copies")


def _build(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("p")
    graph = Graph(_unit(part["vec"]))
    return pd.DataFrame({"label": part["label"].iloc[:1], "size": part["size"].iloc[:1], "shard": part["shard"].iloc[:1],
                         "graph": [pickle.dumps((graph, part["p"].to_numpy(), part["copies"].to_numpy()), protocol=5)]})


def _query(shard: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
    """One block of queries against one shard."""
    graph, ids, copies = pickle.loads(shard["graph"].iloc[0])
    q, p = _unit(part["vec"]), part["p"].to_numpy()
    order = np.argsort(ids)
    at = order[np.minimum(np.searchsorted(ids, p, sorter=order), len(ids) - 1)]
    own = np.where(ids[at] == p, at, -1)
    audit = np.flatnonzero(p % AUDIT_EVERY == 0) if len(p) > AUDIT_EVERY else np.arange(len(p))
    truth = sum(int((q[audit[a:a + STEP]] @ graph.x.T >= SIMILAR).sum()) for a in range(0, len(audit), STEP))
    beam = FIRST_BEAM
    while True:
        found = sum(len(graph.within(q[audit[a:a + STEP]], own[audit[a:a + STEP]], beam)[0]) for a in range(0, len(audit), STEP))
        if found >= truth or beam >= len(ids):
            break
        beam *= 2
    links, pairs = np.zeros(len(p), np.int64), []
    for a in range(0, len(p), STEP):
        row, node = graph.within(q[a:a + STEP], own[a:a + STEP], beam)
        other = ids[node] != p[a + row]
        row, node = a + row[other], node[other]
        links += np.bincount(row, copies[node], len(p)).astype(np.int64)
        pairs.append(_forest(p[row], ids[node]))
    v, root = _forest(*(np.concatenate(x) for x in zip(*pairs, strict=True)))
    return pd.DataFrame({"p": np.concatenate([p, v]), "n_links": np.concatenate([links, np.zeros(len(v), np.int64)]),
                         "other": np.concatenate([p, root])})


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """``vec_id, embedding, label`` -> ``vec_id, n_links, component_id, kept`` for every row."""
    pts = stored(points(embeddings), "points")
    sized = pts.withColumn("size", F.size("vec"))
    counts = sized.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n"))
    dealt = sized.join(counts, ["label", "size"])
    h = F.xxhash64("p")
    shards = stored(dealt.withColumn("shard", F.pmod(h, F.ceil(F.col("n") / SHARD_POINTS))).groupBy("label", "size", "shard")
                    .applyInPandas(_build, "label int, size int, shard bigint, graph binary"), "shards")
    blocks = stored(dealt.select("label", "size", F.pmod(h, F.ceil(F.col("n") / BLOCK_POINTS)).alias("block"), "p", "vec"), "blocks")
    # every point goes to every shard of its label; a graph goes out once for each block of about BLOCK_POINTS
    names, key = shards.select("label", "size", "shard"), ["label", "size", "shard", "block"]
    graphs = shards.join(blocks.select("label", "size", "block").distinct(), ["label", "size"]).select(*(F.col(c).alias(c) for c in (*key, "graph")))
    asked = blocks.join(names, ["label", "size"]).select(*(F.col(c).alias(c) for c in (*key, "p", "vec")))
    found = stored(graphs.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_query, "p bigint, n_links bigint, other bigint"), "links")
    linked = found.groupBy("p").agg(F.sum("n_links").alias("links"))
    roots = components(found.select(F.col("p").alias("a"), F.col("other").alias("b")))
    placed = relabel(pts.withColumn("c", F.col("p")), roots, "c").join(linked, "p").select("label", "vec", "c", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    v = F.col("embedding").cast("array<double>")
    own = embeddings.select("vec_id", "label", v.alias("vec")).join(
        placed.withColumnsRenamed({"label": "_l", "vec": "_v"}), (F.col("label") == F.col("_l")) & (F.col("vec") == F.col("_v")), "left")
    kept = stored(own.select("vec_id", "c", F.coalesce("n_links", F.lit(0)).alias("n_links")), "vectors")
    named = kept.where("c is not null").groupBy("c").agg(F.min("vec_id").alias("name"))
    out = kept.join(named, "c", "left").withColumn("component_id", F.when(F.col("c").isNull(), F.col("vec_id")).otherwise(F.col("name")))
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
