"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts become sets of word 5-grams; two texts link when their sets' Jaccard
similarity is at least the threshold (0.8).

1. One pass hashes every text's shingles to 128 MinHash values of 16 bits,
   read as 32 bands of four values. At similarity 0.8 two texts share a band
   with probability 1 - (1 - 0.8^4)^32 = 1 - 5e-8.
2. Texts with equal shingle sets become one class (linked by definition),
   so copies never meet pairwise.
3. Classes that share a band are connected; each connected group of
   candidates goes to a task (large groups in pairs of blocks).
4. In a group, every pair is compared 16 MinHash values at a time; with a
   uniform prior on the similarity, the posterior probability of reaching the
   threshold after m of n equal values is P(Bin(n + 1, t) <= m). A pair is
   dropped when that falls below ``tolerance``.
5. What is left is verified exactly on the shingle sets, and verified links
   give classes, link counts and components.

Edge cases. NULL or empty text, or text without a word: no shingles, so no
links. Fewer than five words: one shingle of all words. Words are maximal
runs of characters other than ASCII white space of the lower-cased text.
Repeated rows are copies of each other. A NULL doc_id takes part; it counts as
the last id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import in_blocks, land, mix64, ship, text_key
from opinio.llm.components import connected_components

ship(__name__)

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 128
STEP = 16
TOLERANCE = 1e-9
BLOCK_ROWS = 1024

_rng = np.random.default_rng(20)
_MUL = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_PLACE = np.random.default_rng(21).integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHash(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, seen: _WordHash, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    total = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        total += h[j:len(words) - n + 1 + j] * _PLACE[j]
    return np.unique(mix64(total + np.uint64(n)))


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), HASHES) uint16 signatures of non-empty sets."""
    out = np.empty((len(sets), HASHES), np.uint16)
    at = 0
    while at < len(sets):
        stop, total = at, 0
        while stop < len(sets) and (stop == at or total + len(sets[stop]) <= 65536):
            total += len(sets[stop])
            stop += 1
        x = np.concatenate(sets[at:stop])
        starts = np.cumsum([0] + [len(s) for s in sets[at:stop - 1]])
        for i in range(HASHES):
            v = (x ^ _XOR[i]) * _MUL[i]
            v ^= v >> np.uint64(32)
            out[at:stop, i] = (np.minimum.reduceat(v, starts) & np.uint64(0xFFFF)).astype(np.uint16)
        at = stop
    return out


def min_equal(threshold: float, tolerance: float) -> dict[int, int]:
    """n compared values -> fewest equal ones with which a pair stays."""
    need = {}
    for n in range(STEP, HASHES + 1, STEP):
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        need[n] = m
    return need


def prune(sig_a: np.ndarray, sig_b: np.ndarray | None, need: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that survive the incremental comparison; ``sig_b`` None: pairs within ``sig_a``."""
    within = sig_b is None
    sig_b = sig_a if within else sig_b
    out_i, out_j = [], []
    rows = max(1, 2_000_000 // max(1, len(sig_b)))
    for lo in range(0, len(sig_a), rows):
        part = sig_a[lo:lo + rows]
        equal = np.zeros((len(part), len(sig_b)), np.uint8)
        for k in range(STEP):
            equal += part[:, k, None] == sig_b[None, :, k]
        i, j = np.nonzero(equal >= need[STEP])
        m = equal[i, j].astype(np.int32)
        if within:
            keep = i + lo < j
            i, j, m = i[keep], j[keep], m[keep]
        for n in range(2 * STEP, HASHES + 1, STEP):
            m = m + (part[i, n - STEP:n] == sig_b[j, n - STEP:n]).sum(1)
            keep = m >= need[n]
            i, j, m = i[keep], j[keep], m[keep]
        out_i.append(i + lo)
        out_j.append(j)
    return np.concatenate(out_i or [np.empty(0, int)]), np.concatenate(out_j or [np.empty(0, int)])


def linked(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the index pairs reach the threshold, exactly."""
    la = np.array([len(s) for s in a])
    lb = np.array([len(s) for s in b])
    out = np.zeros(len(i), bool)
    if len(i) == 0:
        return out
    used_a, used_b = np.unique(i), np.unique(j)
    every, count = np.unique(np.concatenate([a[k] for k in used_a] + [b[k] for k in used_b]), return_counts=True)
    common = every[count > 1]
    if len(used_a) * len(used_b) * len(common) / 2e10 < len(i) * 2e-5:
        # many pairs over few shared shingles: one 0/1 matrix product per column block
        row_a = np.full(len(a), -1)
        row_a[used_a] = np.arange(len(used_a))
        row_b = np.full(len(b), -1)
        row_b[used_b] = np.arange(len(used_b))
        meet = np.zeros((len(used_a), len(used_b)), np.float32)
        for lo in range(0, len(common), 4096):
            cols = common[lo:lo + 4096]

            def spread(sets, used):
                m = np.zeros((len(used), len(cols)), np.float32)
                for r, k in enumerate(used):
                    at = np.searchsorted(cols, sets[k])
                    at[at == len(cols)] = 0
                    m[r, at[cols[at] == sets[k]]] = 1
                return m

            meet += spread(a, used_a) @ spread(b, used_b).T
        shared = meet[row_a[i], row_b[j]]
    else:
        shared = np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j)])
    union = la[i] + lb[j] - shared
    # |A n B| / |A u B| >= t without rounding trouble at the threshold
    return np.asarray(shared >= threshold * union - 1e-9, bool)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, t, cls, sig): text digest, digest of the shingle set, 32 bands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = _WordHash()
        for batch in batches:
            sets = [shingles(t, seen) for t in batch["text"]]
            full = [k for k, s in enumerate(sets) if len(s)]
            sig = [None] * len(sets)
            cls = [None] * len(sets)
            if full:
                bands = minhash([sets[k] for k in full]).view(np.int64)
                for k, row in zip(full, bands):
                    sig[k] = row
                    cls[k] = xxhash.xxh3_128_digest(sets[k].tobytes())
            yield pd.DataFrame({"id": batch["id"], "t": batch["t"], "cls": cls, "sig": sig})

    src = docs.select(F.col(id_col).cast("bigint").alias("id"), text_key(F.col(text_col)).alias("t"),
                      F.col(text_col).alias("text"))
    return src.mapInPandas(run, "id bigint, t binary, cls binary, sig array<bigint>")


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``docs``: id, n_links (other rows linked directly),
    component_id (smallest id reachable by links, itself included), kept
    (it is that row's id; NULL ids: kept where the whole component has none),
    cls (class of equal shingle sets; NULL without words)."""
    spark = docs.sparkSession
    sigs = land(signatures(docs, id_col, text_col), "jaccard-sig")
    classes = land(sigs.where("cls is not null").groupBy("cls").agg(
        F.min("t").alias("t"), F.min("id").alias("low"), F.count(F.lit(1)).alias("n"),
        F.any_value("sig").alias("sig")), "jaccard-class")

    # classes that share a band: a star around the band's smallest class
    bands = classes.select("cls", F.posexplode("sig").alias("band", "value"))
    low = (bands.groupBy("band", "value").agg(F.min("cls").alias("hub"), F.count(F.lit(1)).alias("n"))
           .where("n > 1").drop("n"))
    stars = bands.join(low, ["band", "value"]).where("cls != hub").select("cls", "hub")
    groups = land(connected_components(stars, "cls", "hub"), "jaccard-groups")

    texts = docs.select(text_key(F.col(text_col)).alias("t"), F.col(text_col).alias("text")) \
        .groupBy("t").agg(F.any_value("text").alias("text"))
    members = (groups.withColumnRenamed("node", "cls").join(classes, "cls")
               .select("cls", "root", "t", "n", F.col("sig")).join(texts, "t").drop("t"))
    need = min_equal(threshold, tolerance)

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        seen = _WordHash()
        bi, bj = int(group["bi"].iloc[0]), int(group["bj"].iloc[0])
        left = group[group["blk"] == bi]
        right = left if bi == bj else group[group["blk"] == bj]
        sets_a = [shingles(t, seen) for t in left["text"]]
        sets_b = sets_a if bi == bj else [shingles(t, seen) for t in right["text"]]
        sig = lambda g: np.array(g["sig"].tolist(), np.int64).view(np.uint16)
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame({"cls": [], "other": [], "links": []})
        i, j = prune(sig(left), None if bi == bj else sig(right), need)
        ok = linked(sets_a, sets_b, i, j, threshold)
        i, j = i[ok], j[ok]
        n_a, n_b = left["n"].to_numpy(), right["n"].to_numpy()
        links_a = np.bincount(i, weights=n_b[j], minlength=len(left))
        links_b = np.bincount(j, weights=n_a[i], minlength=len(right))
        # a spanning forest of the links carries their components
        both = list(left["cls"]) + ([] if bi == bj else list(right["cls"]))
        shift = 0 if bi == bj else len(left)
        top = np.arange(len(both))

        def find(x):
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        for x, y in zip(i, j + shift):
            x, y = find(x), find(y)
            if x != y:
                top[max(x, y)] = min(x, y)
        links = links_a + links_b if bi == bj else np.concatenate([links_a, links_b])
        return pd.DataFrame({"cls": both, "other": [both[find(x)] for x in range(len(both))],
                             "links": links.astype(np.int64)})

    found = land(in_blocks(members, "root", "cls", block_rows).groupBy("root", "bi", "bj")
                 .applyInPandas(verify, "cls binary, other binary, links bigint"), "jaccard-links")
    components = connected_components(found.where("cls != other"), "cls", "other")
    per_class = (classes.select("cls", "low", "n")
                 .join(found.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left")
                 .join(components.withColumnRenamed("node", "cls"), "cls", "left")
                 .withColumn("root", F.coalesce("root", "cls")))
    lows = per_class.groupBy("root").agg(F.min("low").alias("component_id"))
    per_class = per_class.join(lows, "root").select(
        "cls", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id", "root")
    out = sigs.select("id", "cls", "t").join(per_class, "cls", "left")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce(F.when(F.col("root").isNotNull(), F.col("component_id")), F.col("id")).alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce(F.when(F.col("root").isNotNull(), F.col("component_id")), F.col("id")))
        .alias("kept"),
        "cls", "t", F.coalesce("root", F.concat("t", F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")))
        .alias("component_key"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked texts: the one with the
    smallest id (repeated rows of that id count once)."""
    links = jaccard_links(docs, id_col, text_col)
    stay = links.where("kept").groupBy("component_key").agg(F.min(F.struct(id_col, "t")).alias("s"))
    keys = stay.select(F.col(f"s.{id_col}").alias("_id"), F.col("s.t").alias("_t")).distinct()
    # the row travels as one struct, so no column's name can clash with those used here
    once = docs.select(F.struct("*").alias("row"), text_key(F.col(text_col)).alias("t"), F.col(id_col).cast("bigint").alias("id"))
    hit = once.join(keys, F.col("id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), "left_semi")
    return hit.dropDuplicates(["id", "t"]).select("row.*")


def op3_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from opinio.llm.common import table
    return jaccard_links(table(spark, sf_dir, "documents")).select("doc_id", "n_links", "component_id", "kept")


#: Brute force by shared shingles, then label propagation to the smallest id.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[ \t\n\r\x0b\x0c]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, least(i + 4, len(ws))), ' ') AS sh
  FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS u(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE m >= 0.8 * (x.c + y.c - m) - 1e-9),
r AS (SELECT doc_id AS id, doc_id AS low FROM documents UNION SELECT l.a, r.low FROM r JOIN l ON l.b = r.id),
c AS (SELECT id, min(low) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, (SELECT count(*) FROM l WHERE l.a = d.doc_id) AS n_links, component_id,
       d.doc_id = component_id AS kept
FROM documents d JOIN c ON c.id = d.doc_id
"""
