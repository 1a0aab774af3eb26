"""Nearest neighbours by a forest of random-projection trees.

* Fit: on a bounded sample of distinct vectors (``sample_rows``), every tree
  splits by the direction between two random sample points at the median, down
  to ``leaf_rows`` sample points. The forest's size is bounded by the sample's.
* Index: every row is routed through all trees; (tree, leaf) is its place.
* Search: one priority queue holds the open branches of all trees, ordered by the
  sum of squared distances to the splitting planes on whose far side a branch
  lies. The queue first reaches the query's own leaf in every tree; the k-th smallest
  distance to their sample points is the query's radius r. Further leaves are taken until
  the least sum exceeds (reach * r)^2 * depth / dimensions: across one random
  direction a neighbour at distance r is about r / sqrt(dimensions) away. So the
  work follows each query's surroundings and not the number of rows: clustered
  vectors need a few leaves, vectors without any structure a large part of the index.
* Leaf candidates are compared exactly (double precision) where they lie; the best k of
  each task are merged.

Rows and visits travel by parcel, the subtree that holds about ``block_rows`` rows: a
query's vector goes once to each parcel with the list of leaves to look at there, and a row
once a tree, in the precision of its column. Parcels that the sample shows to hold more
than twice ``block_rows`` rows are dealt to several tasks. Equal vectors are one member of
the index with their ``k + 1`` smallest ids (more copies cannot enter a result of k), so
copies cannot swell a leaf.

Edge cases. Vectors that are NULL, empty, zero or hold a NULL, NaN or infinite
component, and rows whose id is NULL, take no part. Vectors of another length than
the query are no candidates. Rows of the same id and vector count once. With fewer than k
candidates all are returned; no usable rows give an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinio.llm.common import land, ship, table
from opinio.llm.embed_dedup import precision, usable, vector_key

ship(__name__)

TREES = 8
SAMPLE_ROWS = 50_000
LEAF_ROWS = 64
REACH = 0.28
BLOCK_ROWS = 4096


class Forest:
    """Complete binary trees: node i has children 2i + 1 and 2i + 2; the last level are leaves."""

    def __init__(self, sample: np.ndarray, trees: int, leaf_rows: int, seed: int):
        rng = np.random.default_rng(seed)
        n, dim = sample.shape
        self.dim, self.trees, self.sample = dim, trees, sample
        self.depth = max(0, int(np.ceil(np.log2(max(1, n / leaf_rows)))))
        self.inner = 2**self.depth - 1
        self.plane = np.zeros((trees, self.inner, dim))
        self.cut = np.zeros((trees, self.inner))
        self.held: list[list[np.ndarray]] = []  # sample points of each leaf
        for t in range(trees):
            members = {0: np.arange(n, dtype=np.int32)}
            for node in range(self.inner):
                own = members.pop(node)
                a, b = rng.choice(own, 2) if len(own) else (0, 0)
                way = sample[a].astype(np.float64) - sample[b]
                if not way.any():
                    way = rng.standard_normal(dim)
                way = way / np.linalg.norm(way)
                x = sample[own] @ way
                cut = np.median(x) if len(own) else 0.0
                self.plane[t, node], self.cut[t, node] = way, cut
                members[2 * node + 1], members[2 * node + 2] = own[x <= cut], own[x > cut]
            self.held.append([members[self.inner + leaf] for leaf in range(self.inner + 1)])

    def route(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees) leaf numbers."""
        out = np.zeros((len(x), self.trees), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", self.plane[t, node], x) > self.cut[t, node]
                node = 2 * node + 1 + side
            out[:, t] = node - self.inner
        return out

    def radius(self, x: np.ndarray, leaves: list[tuple[int, int]], k: int) -> float:
        """k-th smallest distance to other sample points of ``leaves``; infinite where they are fewer."""
        near = np.unique(np.concatenate([self.held[t][leaf] for t, leaf in leaves]))
        gap = self.sample[near].astype(np.float64) - x
        far = (gap * gap).sum(1)
        far = far[far > 0]
        return float(np.sqrt(np.partition(far, k - 1)[k - 1])) if len(far) >= k else np.inf

    def search(self, x: np.ndarray, k: int, reach: float) -> list[list[tuple[int, int]]]:
        """Leaves (tree, leaf) to look at, for each query."""
        out = []
        flat = self.plane.reshape(self.trees * self.inner, -1)
        share = min(1.0, self.depth / self.dim)
        for lo in range(0, len(x), 256):
            gap = np.nan_to_num((x[lo:lo + 256] @ flat.T).reshape(-1, self.trees, self.inner) - self.cut)  # overflow
            for v, g in zip(x[lo:lo + 256], gap):
                heap = [(-1.0, t, 0) for t in range(self.trees)]
                limit, leaves = np.inf, []
                while heap and heap[0][0] <= limit:
                    near, t, node = heapq.heappop(heap)
                    near, row = max(near, 0.0), g[t]
                    while node < self.inner:
                        m = row[node]
                        near_side, far_side = (2 * node + 2, 2 * node + 1) if m > 0 else (2 * node + 1, 2 * node + 2)
                        if near + m * m <= limit:
                            heapq.heappush(heap, (near + m * m, t, far_side))
                        node = near_side
                    leaves.append((t, node - self.inner))
                    if len(leaves) == self.trees:  # each tree's own leaf
                        limit = (reach * self.radius(v, leaves, k)) ** 2 * share if self.depth else np.inf
                out.append(leaves)
        return out


class Parcels:
    """Subtrees that hold about ``block_rows`` of a forest's ``rows`` rows, and the tasks each is dealt to."""

    def __init__(self, forest: Forest, rows: float, block_rows: int):
        level = min(forest.depth, max(0, int(np.ceil(np.log2(max(1.0, rows / block_rows))))))
        self.shift = forest.depth - level
        held = np.array([[len(own) for own in tree] for tree in forest.held], float).reshape(forest.trees, 2**level, -1).sum(2)
        self.blocks = np.maximum(1, np.ceil(held / max(1, len(forest.sample)) * rows / (2 * block_rows))).astype(np.int64)


def nearest(emb: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            trees: int = TREES, sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS, reach: float = REACH,
            block_rows: int = BLOCK_ROWS, seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of ``emb`` found for
    each row of ``queries``, the query's own id left out; Euclidean distance."""
    pick = lambda df: (df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
                       .where(F.col("id").isNotNull() & usable(F.col("vec"))).distinct())
    rows = pick(emb).withColumn("node", vector_key(F.col("vec")))
    first = Window.partitionBy("node").orderBy("id")
    members = land(rows.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k + 1)
                   .groupBy("node").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.any_value("vec").alias("vec")),
                   "ann-members")
    asked = pick(queries)
    kept, sent = precision(emb, vec_col), precision(queries, vec_col)

    count = members.count()
    keep = min(1.0, 1.2 * sample_rows / max(1, count))
    drawn = members.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1_000_000)) < F.lit(int(keep * 1_000_000)))
    by_dim: dict[int, list] = {}
    for v in drawn.select("vec").limit(sample_rows).toArrow()["vec"].to_numpy():
        by_dim.setdefault(len(v), []).append(v.astype(kept))
    drawn_rows = max(1, sum(map(len, by_dim.values())))
    forests = {d: Forest(np.stack(v), trees, leaf_rows, seed) for d, v in by_dim.items()}
    dealt = {d: Parcels(f, count * len(f.sample) / drawn_rows, block_rows) for d, f in forests.items()}

    def forest_of(dim: int) -> tuple[Forest, Parcels]:
        if dim not in forests:  # a length the sample does not hold: one leaf, of hardly more than 20 in a sample's rows
            forests[dim] = Forest(np.zeros((1, dim)), 1, leaf_rows, seed)
            dealt[dim] = Parcels(forests[dim], 20 * count / drawn_rows, block_rows)
        return forests[dim], dealt[dim]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["vec"].map(len)):
                forest, parcels = forest_of(dim)
                x = np.stack(part["vec"].to_numpy())
                leaves = forest.route(x)
                raw = [v.tobytes() for v in x.astype(kept)]
                key = part["key"].to_numpy()
                for t in range(forest.trees):
                    parcel = leaves[:, t] >> parcels.shift
                    yield pd.DataFrame({"dim": dim, "tree": t, "parcel": parcel, "block": key % parcels.blocks[t, parcel],
                                        "leaf": leaves[:, t], "ids": part["ids"], "raw": raw})

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["vec"].map(len)):
                forest, parcels = forest_of(dim)
                x = np.stack(part["vec"].to_numpy())
                for name, v, visits in zip(part["id"].to_list(), x.astype(sent), forest.search(x, k, reach)):
                    by_parcel: dict[tuple[int, int], list[int]] = {}
                    for t, leaf in visits:
                        by_parcel.setdefault((t, leaf >> parcels.shift), []).append(leaf)
                    at = [(t, p, block, leaves) for (t, p), leaves in by_parcel.items() for block in range(parcels.blocks[t, p])]
                    tree, parcel, block, leaves = zip(*at)
                    yield pd.DataFrame({"dim": dim, "tree": tree, "parcel": parcel, "block": block, "query_id": name,
                                        "leaves": leaves, "raw": v.tobytes()})

    at = ["dim", "tree", "parcel", "block"]
    where = "dim int, tree int, parcel int, block bigint"
    placed = (members.select("ids", "vec", F.pmod(F.xxhash64("node"), F.lit(1 << 40)).alias("key"))
              .mapInPandas(place, where + ", leaf int, ids array<bigint>, raw binary"))
    visits = asked.select("id", "vec").mapInPandas(ask, where + ", query_id bigint, leaves array<int>, raw binary")

    def rank(key, have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        if len(have) == 0 or len(want) == 0:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        have = have.sort_values("leaf", kind="stable")
        x = np.stack([np.frombuffer(v, kept) for v in have["raw"]]).astype(np.float64)
        ids = have["ids"].to_list()
        there, starts, lies = np.unique(have["leaf"].to_numpy(), return_index=True, return_inverse=True)
        ends = [*starts[1:], len(x)]
        square = (x * x).sum(1)
        norm, top = np.sqrt(square), min(len(x), k + 1)  # one may be the query's own row
        grain = 4 * np.finfo(np.float64).eps * (x.shape[1] + 4)
        found = []
        for lo in range(0, len(want), 512):
            part = want.iloc[lo:lo + 512]
            q = np.stack([np.frombuffer(v, sent) for v in part["raw"]]).astype(np.float64)
            looks = np.stack([np.isin(there, leaves) for leaves in part["leaves"]])
            rough = np.full((len(q), len(x)), np.inf)
            for j, (s, e) in enumerate(zip(starts, ends)):
                who = np.flatnonzero(looks[:, j])
                rough[who, s:e] = square[s:e] - 2 * (q[who] @ x[s:e].T)
            # all that rounding or a tie may put among the first, whatever their number
            slack = grain * (norm[None, :] + np.linalg.norm(q, axis=1)[:, None]) ** 2
            last = np.partition(rough + slack, top - 1, axis=1)[:, top - 1]
            near = [np.flatnonzero(seen[lies] & ~(r > m)) for seen, r, m in zip(looks, rough - slack, last)]
            for name, v, some in zip(part["query_id"].tolist(), q, near):
                gap = x[some] - v
                score = np.sqrt((gap * gap).sum(1))
                mine = [(s, i) for s, m in zip(score.tolist(), some) for i in ids[m] if i != name]
                mine = heapq.nsmallest(k, mine)
                found += [(name, i, s) for s, i in mine]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = (placed.groupBy(*at).cogroup(visits.groupBy(*at))
             .applyInPandas(rank, "query_id bigint, vec_id bigint, score double"))
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_rp_forest_neighbours(spark, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return nearest(emb, emb.where("vec_id % 100 = 0"))
