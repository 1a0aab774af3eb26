"""Near-duplicate embeddings by sorted projection passes.

Each pass hashes every vector to the signs of its projections on fresh random
directions, sorts all vectors by the concatenated signs and compares each
with its next ``window`` neighbours in that order; pairs with cosine >= the
threshold (double precision, original vectors) are links. The links of all
passes are united into components, and inside each component every pair is
compared (large components in pairs of blocks), so ``n_links`` counts all links
between members, not only those that fell into a window. Equal vectors are one
class from the start, so copies take one place in every window.

Passes go on until no vector is likely to have missed a link. Vectors at cosine c
agree in a sign with probability 1 - acos(c)/pi. If no vector outside a vector's
window agrees with it in its first b signs, the pass meets each of its links with
probability at least (1 - acos(threshold)/pi)^b. b is read off the sorted
keys, so it is small in thin regions and large in dense ones. A vector is done when its
passes together miss a link with probability <= ``miss``; the others, with wider windows, go
through further passes among themselves (a pair with one end done was met by that end). The
first round's passes follow from the number of distinct vectors, later rounds'
from what the last round reached. Every table goes through the first round, whatever its size. The rest is
exact: as soon as comparing all pairs of those left is less work than the passes
they still need, that is done instead, which misses nothing. Rows
at the unknown end of a range of keys count as not having had the pass. Vectors travel in the precision of
their column and are compared in double precision.

Edge cases. A vector that is NULL, empty, zero, or holds a NULL, NaN or
infinite component links with nothing: n_links 0, a component of its own.
Vectors of different length do not link. Repeated rows are copies of each
other; a NULL vec_id takes part. An empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import in_blocks, land, ship, table, width
from opinio.llm.components import connected_components

ship(__name__)

THRESHOLD = 0.95
MISS = 1e-3  # probability of missing a pair at the threshold
WINDOW = 32
WIDE = 512  # window of the rounds after the first
MOST_PASSES = 48  # of one round: bounds what a round holds on disk
BITS = 62
BLOCK_ROWS = 2048
BLOCK = 256  # rows of a range compared at once


def usable(vec: Column) -> Column:
    """Neither NULL, empty, zero nor holding a NULL, NaN or infinite component."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & good & F.exists(vec, lambda x: x != 0), F.lit(False))


def precision(df: DataFrame, vec_col: str) -> type:
    """The numpy type that holds the column's components without loss."""
    element = df.select(vec_col).schema[0].dataType.elementType.typeName()
    return np.float32 if element == "float" else np.float64


def vector_key(vec: Column) -> Column:
    """128-bit digest of the exact components."""
    return F.unhex(F.md5(F.array_join(F.transform(vec, lambda x: x.cast("string")), ",")))


def unit(rows: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in rows])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def directions(dim: int, passes: int, seed: int, turn: int) -> np.ndarray:
    return np.random.default_rng([seed, turn, dim]).standard_normal((dim, passes * BITS))


def agree(threshold: float) -> float:
    """Probability that two vectors at the threshold agree in one sign."""
    return 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi


def first_passes(n: int, threshold: float, window: int, miss: float) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss`` among ``n`` vectors without clusters."""
    met = agree(threshold) ** max(0.0, math.log2(max(1, n) / window))
    return 1 if met >= 1 - miss else math.ceil(math.log(miss) / math.log1p(-met))


def keyed(classes: DataFrame, passes: int, seed: int, turn: int, kept: type = np.float64) -> DataFrame:
    """(pass, dim, key, node, vec as bytes of type ``kept``) for every class and pass."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
        planes: dict[int, np.ndarray] = {}
        for whole in batches:
            for lo in range(0, len(whole), 2048):
                batch = whole.iloc[lo:lo + 2048]
                for dim, part in batch.groupby(batch["vec"].map(len)):
                    if dim not in planes:
                        planes[dim] = directions(dim, passes, seed, turn)
                    x = unit(part["vec"])
                    raw = [np.asarray(v, kept).tobytes() for v in part["vec"]]
                    for p in range(passes):
                        key = (x @ planes[dim][:, p * BITS:(p + 1) * BITS] > 0) @ weight
                        yield pd.DataFrame({"pass": p, "dim": dim, "key": key, "node": part["node"], "vec": raw})

    return classes.select("node", "vec").mapInPandas(run, "pass int, dim int, key bigint, node binary, vec binary")


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links (below ``n``) that join the same rows as the links ``a``, ``b`` among rows 0..n-1."""
    low = np.arange(n)
    while len(a):
        m = np.minimum(low[a], low[b])
        if (m == low[a]).all() and (m == low[b]).all():
            break
        for ends in (a, b):
            np.minimum.at(low, low[ends], m)
            np.minimum.at(low, ends, m)
        low = low[low]
    at = np.flatnonzero(low != np.arange(n))
    return at, low[at]


def shared_signs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading signs in which two keys agree."""
    x = a ^ b
    return BITS - np.frexp((x & ~(x >> 1)).astype(np.float64))[1]


def window_links(threshold: float, window: int, kept: type = np.float64):
    """Of one sorted range: spanning links (a, b) among window neighbours, and for each row (a, NULL)
    how much its pass adds to -log(probability that a link of it is missed)."""
    p_sign = agree(threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, done = None, 0
        for batch in itertools.chain(batches, [None]):
            if batch is None and held is None:
                return
            frame = held if batch is None else batch if held is None else pd.concat([held, batch], ignore_index=True)
            upto = len(frame) if batch is None else max(done, len(frame) - window - 1)
            if upto > done:
                yield from look(frame, done, upto)
            cut = max(0, upto - window - 1)
            held, done = frame.iloc[cut:].reset_index(drop=True), upto - cut

    def look(frame: pd.DataFrame, done: int, upto: int) -> Iterator[pd.DataFrame]:
        """Rows done..upto-1 against those behind them; those before ``done`` and from ``upto`` on are context."""
        n, nodes, key, vec = len(frame), frame["node"].to_numpy(), frame["key"].to_numpy(), frame["vec"].to_numpy()
        dim = frame["dim"].to_numpy()
        group = frame["pass"].to_numpy().astype(np.int64) << 32 | dim
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        a, b = [], []
        for s, e in zip(starts, [*starts[1:], n]):
            s = max(s, done)
            if s >= min(e, upto):
                continue
            x = np.frombuffer(b"".join(vec[s:e]), kept).astype(np.float64).reshape(-1, dim[s])
            u = unit(x)
            for lo in range(0, min(e, upto) - s, BLOCK):
                hi = min(lo + BLOCK, min(e, upto) - s)
                i, j = np.nonzero(u[lo:hi] @ u[lo:hi + window].T >= threshold)
                ahead = j > i
                a.append(i[ahead] + s + lo)
                b.append(j[ahead] + s + lo)
        at = np.arange(done, upto)
        signs, known = np.zeros(len(at), np.int64), np.ones(len(at), bool)
        for other in (at + window + 1, at - window - 1):
            inside = (other >= 0) & (other < n)
            known &= inside
            o = np.where(inside, other, at)
            signs = np.maximum(signs, np.where(group[o] == group[at], shared_signs(key[o], key[at]) + 1, 0))
        gain = np.where(known, -np.log1p(-np.minimum(p_sign ** signs, 1 - 1e-12)), 0.0)
        i, j = spanning(n, np.concatenate(a), np.concatenate(b))
        yield pd.DataFrame({"a": np.concatenate([nodes[i], nodes[at]]),
                            "b": np.concatenate([nodes[j], np.full(len(at), None, object)]),
                            "gain": np.concatenate([np.zeros(len(i)), gain])})

    return run


def all_pairs(left: DataFrame, n: int, threshold: float, block_rows: int) -> DataFrame:
    """Spanning links of every pair among ``n`` vectors, in pairs of blocks."""
    blocks = max(1, math.ceil(n / block_rows))

    def pairs(group: pd.DataFrame) -> pd.DataFrame:
        bi, bj = int(group["bi"].iloc[0]), int(group["bj"].iloc[0])
        nodes, dim = group["node"].to_numpy(), group["vec"].map(len).to_numpy()
        blk, a, b = group["blk"].to_numpy(), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d in np.unique(dim):
            x, y = (np.flatnonzero((dim == d) & (blk == k)) for k in (bi, bj))
            if len(x) and len(y):
                u, v = (unit(group["vec"].iloc[k]) for k in (x, y))
                for lo in range(0, len(x), 512):
                    i, j = np.nonzero(u[lo:lo + 512] @ v.T >= threshold)
                    a.append(x[i + lo])
                    b.append(y[j])
        i, j = spanning(len(group), np.concatenate(a), np.concatenate(b))
        return pd.DataFrame({"a": nodes[i], "b": nodes[j]})

    out = (left.select("node", "vec", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("blk"))
           .withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    return (out.withColumn("bi", F.least("blk", "o")).withColumn("bj", F.greatest("blk", "o")).drop("o")
            .groupBy("bi", "bj").applyInPandas(pairs, "a binary, b binary"))


def all_links(classes: DataFrame, threshold: float, window: int, miss: float, seed: int, block_rows: int,
              kept: type = np.float64) -> DataFrame:
    """Links that join every component; see the module's text."""
    spark = classes.sparkSession
    target = -math.log(miss)
    left = classes.select("node", "vec", F.lit(0.0).alias("had"))
    n = left.count()
    need = first_passes(n, threshold, window, miss)
    found, turn = [], 0
    while n > 1 and (turn == 0 or n > 2 * window * need):
        passes = min(need, MOST_PASSES)
        parts = max(1, min(width(spark), n * passes // (16 * window)))
        order = ["pass", "dim", "key", "node"]
        ranges = keyed(left, passes, seed, turn, kept).repartitionByRange(parts, *order).sortWithinPartitions(*order)
        seen = land(ranges.mapInPandas(window_links(threshold, window, kept), "a binary, b binary, gain double"), "embed-pass")
        found.append(seen.where("b is not null").select("a", "b"))
        gains = seen.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("gain").alias("gain"))
        left = land(left.select("node", "vec", "had").join(gains, "node").select("node", "vec", (F.col("had") + F.col("gain")).alias("had"), "gain")
                    .where(F.col("had") < F.lit(target)), "embed-left")
        n, had, gain = left.agg(F.count(F.lit(1)), F.avg("had"), F.avg("gain")).first()
        if n:
            need = math.ceil(min(1e15, max(1.0, (target - had) * passes / max(gain, 1e-15))))
        window, turn = max(window, WIDE), turn + 1
    if n > 1:
        found.append(all_pairs(left, n, threshold, max(block_rows, BLOCK_ROWS)))
    return functools.reduce(DataFrame.union, found) if found else classes.select(
        F.col("node").alias("a"), F.col("node").alias("b"))


def embedding_links(emb: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, miss: float = MISS, window: int = WINDOW,
                    seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``emb``: id, n_links, component_id, kept."""
    rows = emb.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.select("id", "vec", F.when(usable(F.col("vec")), vector_key(F.col("vec"))).alias("node"))
    classes = land(rows.where("node is not null").groupBy("node").agg(
        F.min("id").alias("low"), F.count(F.lit(1)).alias("n"), F.any_value("vec").alias("vec")), "embed-class")

    links = all_links(classes, threshold, window, miss, seed, block_rows, precision(emb, vec_col))
    components = land(connected_components(links, "a", "b"), "embed-components")

    def count(group: pd.DataFrame) -> pd.DataFrame:
        bi, bj = int(group["bi"].iloc[0]), int(group["bj"].iloc[0])
        left = group[group["blk"] == bi]
        right = left if bi == bj else group[group["blk"] == bj]
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"node": [], "links": []})
        a = unit(left["vec"])
        b = a if bi == bj else unit(right["vec"])
        n_a, n_b = left["n"].to_numpy(), right["n"].to_numpy()
        to_a, to_b = np.zeros(len(a)), np.zeros(len(b))
        for lo in range(0, len(a), 512):
            hit = a[lo:lo + 512] @ b.T >= threshold
            if bi == bj:
                hit[np.arange(len(hit)), lo + np.arange(len(hit))] = False
            to_a[lo:lo + 512] = hit @ n_b
            to_b += n_a[lo:lo + 512] @ hit
        out = [pd.DataFrame({"node": left["node"], "links": to_a.astype(np.int64)})]
        if bi != bj:
            out.append(pd.DataFrame({"node": right["node"], "links": to_b.astype(np.int64)}))
        return pd.concat(out)

    members = components.join(classes, "node").select("node", "root", "n", "vec")
    counts = (in_blocks(members, "root", "node", block_rows).groupBy("root", "bi", "bj")
              .applyInPandas(count, "node binary, links bigint")
              .groupBy("node").agg(F.sum("links").alias("links")))
    per_class = (classes.select("node", "low", "n").join(components, "node", "left")
                 .join(counts, "node", "left").withColumn("root", F.coalesce("root", "node")))
    lows = per_class.groupBy("root").agg(F.min("low").alias("component_id"))
    per_class = per_class.join(lows, "root").select(
        "node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = rows.select("id", "node").join(per_class, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op1_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))


#: All pairs, then propagation of the smallest id.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS id, vec_id AS low FROM embeddings UNION SELECT l.a, r.low FROM r JOIN l ON l.b = r.id),
c AS (SELECT id, min(low) AS component_id FROM r GROUP BY id)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, component_id,
       e.vec_id = component_id AS kept
FROM embeddings e JOIN c ON c.id = e.vec_id
"""
