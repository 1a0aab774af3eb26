"""Suffix-array deduplication by a common-prefix-aware distributed merge sort.

A byte is removed when a string of ``length`` (200) bytes that covers it also
starts at another place of the corpus. Sorting a suffix per byte would shuffle
hundreds of times the input, so a sparse suffix array is sorted, from which
the dense answer follows exactly:

* Anchors. Of the k-byte substrings (k = length / 2) inside every
  ``length``-byte window, the one with the smallest hash (leftmost among
  equals) is the window's anchor. Equal windows have their anchor at the same
  offset, so a repeated window shows as a repeated anchor substring; anchors
  whose substring occurs once cannot matter and stay behind.
* Equal texts. Texts that are equal as a whole are repeated throughout; they are found by their digests,
  and one of each goes on, so a group of copies, however large, is one text to the sort.
* Runs. Each task takes the suffixes (``length`` bytes) at its documents'
  anchors, sorts them, and hands them on front-coded: the length of the prefix
  shared with the suffix before, and the rest. Runs are dealt by ranges of
  the first k bytes, so suffixes that share an anchor substring meet.
* Merge. A loser tree merges the runs of a range; every comparison starts
  behind the prefix both contenders are known to share with the last winner. The result is the
  range's suffix array with its table of common prefix lengths.
* Windows. A window that starts d bytes before an anchor is repeated iff
  another suffix shares its first ``length`` - d bytes (an interval of the
  prefix table) and its d bytes on the left (an interval of the sorted left
  contexts); both are counted for every d.

An anchor substring that occurs more than ``hot`` times would put an unbounded
group into one range; its windows are counted by a grouped aggregation over
128-bit window digests instead, which combines before the shuffle and splits
(exact, without any cap).

Texts lie together in blocks cut by bytes; a very long text is a block of its own and is searched in slices that
overlap, as one text.

Edge cases. NULL or empty text: no bytes, nothing removed. Texts shorter than
``length`` are kept. Repeated rows remove each other. NULL doc_ids are carried
through: rows are told apart by an internal number. An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructType
from pyspark.sql.window import Window

from opinio.llm.common import bundled, land, land_in_buckets, mix64, ship, table, trim, width, worker_cache

ship(__name__)

LENGTH = 200
RANGE_ROWS = 60_000  # suffixes a range is meant to hold
HOT = RANGE_ROWS  # a substring that would fill a range alone goes the other way
BLOCK_BITS = 11
BLOCK_BYTES = 16 << 20
MOST_CUTS = 4096  # ranges are cut at so many places at most; each is dealt on by the anchor's hash
SAMPLED_KEYS = 512  # one anchor string in so many helps to find the cuts
SAMPLED_CUTS = 16  # strings a cut
SLICE = 1 << 20
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def anchor_len(length: int) -> int:
    """Bytes of an anchor substring: long enough that a common line is none,
    short enough to need one anchor in some 50 bytes."""
    return max(1, length // 2)


class Anchors:
    """Anchor places and substring hashes of byte strings."""

    def __init__(self, length: int):
        self.length, self.k = length, anchor_len(length)
        self.up = self.down = np.empty(0, np.uint64)

    def of(self, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) in ``data``, the concatenation of strings that
        start at ``starts``; no anchor substring crosses two strings."""
        n, k, w = len(data), self.k, self.length - self.k + 1
        if n < self.length:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        if len(self.up) < n:
            self.up, self.down = _powers(_R, n), _powers(_R_INV, n)
        b = np.frombuffer(data, np.uint8)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        h = mix64((sums[k:] - sums[:-k]) * self.down[:n - k + 1])
        m = len(h)
        order = (h & ~np.uint64(SLICE * 4 - 1)) | np.arange(m, dtype=np.uint64)
        for s in starts[1:]:
            order[max(0, s - k + 1):s] |= ~np.uint64(SLICE * 4 - 1)
        pad = -m % w
        blocks = np.concatenate([order, np.full(pad, ~np.uint64(0))]).reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, 1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        low = np.minimum(behind[:m - w + 1], ahead[w - 1:m])
        low = low[np.flatnonzero(np.diff(low, prepend=~low[:1]))]
        valid = (low | np.uint64(SLICE * 4 - 1)) != ~np.uint64(0)
        at = np.unique((low[valid] & np.uint64(SLICE * 4 - 1)).astype(np.int64))
        return at, h[at]


def _slices(ids, blobs, length: int):
    """Strings of at most SLICE bytes that overlap by length - 1, concatenated
    up to SLICE bytes: lists of (row id, offset in the row, bytes)."""
    group, size = [], 0
    for i, raw in zip(ids, blobs):
        step = SLICE - (length - 1)
        for lo in range(0, max(1, len(raw) - (length - 1)), step):
            part = raw[lo:lo + SLICE]
            if size + len(part) > SLICE and group:
                yield group
                group, size = [], 0
            group.append((i, lo, part))
            size += len(part)
    if group:
        yield group


def front_code(suffixes: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """(shared prefix with the one before, rest) of sorted byte strings."""
    shared = np.zeros(len(suffixes), np.uint16)
    rest = []
    last = b""
    for r, s in enumerate(suffixes):
        h = common(last, s, 0) if r else 0
        shared[r] = h
        rest.append(s[h:])
        last = s
    return shared, rest


def common(a: bytes, b: bytes, h: int) -> int:
    """Length of the common prefix, known to be at least ``h``."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[h:n], "big") ^ int.from_bytes(b[h:n], "big")
    return n - (x.bit_length() + 7) // 8


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merge sorted runs (strings, prefix shared with the one before) with a
    loser tree. Returns the (run, row) order and the prefix each output
    shares with the output before. No known common prefix is compared again."""
    size = 1
    while size < len(runs):
        size *= 2
    at = [0] * size
    known = [0] * size  # prefix shared with the last winner that passed
    head: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (size - len(runs))
    loser = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs' heads."""
        x, y = head[a], head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        p, q = known[a], known[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        h = common(x, y, p)
        if h == len(x) or (h < len(y) and x[h] < y[h]):
            known[b] = h
            return a, b
        known[a] = h
        return b, a

    def build(node: int) -> int:
        if node >= size:
            return node - size
        win, lose = play(build(2 * node), build(2 * node + 1))
        loser[node] = lose
        return win

    win = build(1) if size > 1 else 0
    order, shared = [], []
    while head[win] is not None:
        order.append((win, at[win]))
        shared.append(known[win])
        strings, prefix = runs[win]
        at[win] += 1
        if at[win] < len(strings):
            head[win], known[win] = strings[at[win]], prefix[at[win]]
        else:
            head[win] = None
        node = (win + size) // 2
        while node:
            win, lose = play(win, loser[node])
            loser[node] = lose
            node //= 2
    if shared:
        shared[0] = 0
    return order, shared


def repeated_windows(shared: np.ndarray, lefts: list[bytes], length: int) -> np.ndarray:
    """(suffixes, length - k + 1) flags: is the window that starts d bytes before the suffix repeated?"""
    n, deepest = len(lefts), length - anchor_len(length)
    flags = np.zeros((n, deepest + 1), bool)
    mirrored = [x[::-1] for x in lefts]
    by_left = sorted(range(n), key=mirrored.__getitem__)
    left_shared = np.zeros(n, np.int64)
    for r in range(1, n):
        left_shared[r] = common(mirrored[by_left[r - 1]], mirrored[by_left[r]], 0)
    rank = np.empty(n, np.int64)
    rank[by_left] = np.arange(n)
    for d in range(deepest + 1):
        right_class = np.cumsum(shared < length - d)
        left_class = np.cumsum(left_shared < d)[rank]
        both = right_class * np.int64(n + 1) + left_class
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        again = np.zeros(n, bool)
        again[1:] |= same
        again[:-1] |= same
        flags[order, d] = again
    return flags


def stored(docs: DataFrame, text_col: str) -> DataFrame:
    """All columns but the text, with rid (number of the row), block (rows that lie together: at most 2048,
    and at most BLOCK_BYTES of text unless it is a single row), z (the text's UTF-8 bytes, compressed) and
    _null (text was NULL), written once, in buckets of the block: the texts are never shuffled afterwards. The block is the rid
    without its last BLOCK_BITS bits."""
    rest = [c for c in docs.columns if c != text_col]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        block, place, size = TaskContext.get().partitionId() << (33 - BLOCK_BITS), 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                some = batch.slice(lo, 500)
                rid, z, size_of, digest, null = [], [], [], [], []
                for t in some[text_col].to_pylist():
                    raw = (t or "").encode("utf-8", "surrogatepass")
                    if place and (place >> BLOCK_BITS or size + len(raw) > BLOCK_BYTES):
                        block, place, size = block + 1, 0, 0
                    rid.append(block << BLOCK_BITS | place)
                    z.append(press.compress(raw))
                    size_of.append(len(raw))
                    digest.append(hashlib.blake2b(raw, digest_size=16).digest())
                    null.append(t is None)
                    place, size = place + 1, size + len(raw)
                yield pa.RecordBatch.from_arrays(
                    [*[some[c] for c in rest], pa.array(rid, pa.int64()), pa.array(null, pa.bool_()), pa.array(z, pa.binary()),
                     pa.array(size_of, pa.int64()), pa.array(digest, pa.binary())],
                    [*rest, "rid", "_null", "z", "size", "digest"])
        trim()

    schema = StructType([docs.schema[c] for c in rest]).add("rid", LongType()).add("_null", BooleanType()).add("z", BinaryType()) \
        .add("size", LongType()).add("digest", BinaryType())
    rows = docs.select(*rest, text_col).mapInArrow(pack, schema)
    return land_in_buckets(rows.withColumn("block", F.shiftright("rid", BLOCK_BITS)), "suffix-rows", "block")


def _unpack(column) -> list[bytes]:
    d = zstandard.ZstdDecompressor()
    return [d.decompress(z) for z in column]


def find_anchors(rids: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rid, place, hash) of the anchors of some texts."""
    anchors = worker_cache().setdefault(("anchors", length), Anchors(length))
    rid, at, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for group in _slices(rids, texts, length):
        starts = np.cumsum([0] + [len(p) for _, _, p in group])
        places, h = anchors.of(b"".join([p for _, _, p in group]), starts[:-1])
        which = np.searchsorted(starts, places, "right") - 1
        rid.append(np.array([g[0] for g in group], np.int64)[which])
        at.append(places - starts[which] + np.array([g[1] for g in group], np.int64)[which])
        keys.append(h.view(np.int64))
    return np.concatenate(rid), np.concatenate(at), np.concatenate(keys)


def repeated_spans(rows: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(rid, lo, hi): byte spans of ``stored`` rows that are covered by repeated windows (spans may overlap)."""
    spark = rows.sparkSession
    k = anchor_len(length)

    # texts that are equal as a whole (and long enough) are repeated throughout; one of each goes on, for others
    # may repeat parts of it
    equal = rows.where(F.col("size") >= length).groupBy("digest").agg(F.min("rid").alias("one"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("digest", "one")
    copies = land(rows.select("rid", "block", "size", "digest").join(equal, "digest").drop("digest"), "suffix-copies")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = _unpack(batch["z"])
            rid, at, keys = find_anchors(batch["rid"].to_numpy(), texts, length)
            text_of = dict(zip(batch["rid"], texts))
            block = rid >> BLOCK_BITS
            for x in np.unique(block):
                mine = np.flatnonzero(block == x)
                key, first, n = np.unique(keys[mine], return_index=True, return_counts=True)
                some = (key % SAMPLED_KEYS) == 0
                strings = [text_of[r][p:p + k] if s else None for s, r, p in
                           zip(some.tolist(), rid[mine][first].tolist(), at[mine][first].tolist())]
                yield pd.DataFrame({"key": key, "block": x, "n": n, "s": strings})
        trim()

    # at most one row per block and substring crosses the network, so a substring
    # of a third of all rows is a row per block; those that occur once end here
    counted = rows.select("rid", "z").mapInPandas(count, "key bigint, block bigint, n bigint, s binary")
    over = Window.partitionBy("key")
    chosen = land(counted.withColumn("all", F.sum("n").over(over)).where("all > 1")
                  .select("block", "key", (F.col("all") > hot).alias("hot"), "n", "s"), "suffix-chosen")

    # ranges of the first k bytes, cut at a sample of the chosen strings themselves; past MOST_CUTS ranges each is dealt
    # on by a hash of these bytes, so the number of parts grows with the data and the cuts stay few
    total = int(chosen.agg(F.sum("n")).first()[0] or 0)
    parts = max(width(spark), -(-total // RANGE_ROWS))
    ranges = min(parts, MOST_CUTS)
    deal = -(-parts // ranges)
    drawn = chosen.where("s is not null and not hot").groupBy("s").agg(F.sum("n").alias("n"))
    many = drawn.count()
    keep = min(1.0, ranges * SAMPLED_CUTS * 4 / max(1, many))
    drawn = sorted((bytes(r.s), r.n) for r in drawn.where(F.pmod(F.xxhash64("s"), F.lit(1 << 30)) < F.lit(keep) * (1 << 30)).collect())
    weight = np.cumsum([n for _, n in drawn]) if drawn else np.zeros(0)
    at_cuts = np.searchsorted(weight, [weight[-1] * i / ranges for i in range(1, ranges)]) if drawn else []
    cuts = [drawn[i][0] for i in sorted(set(at_cuts))]

    def at_chosen(docs_of: pd.DataFrame, keys_of: pd.DataFrame):
        """(rid, place, text) at the chosen anchors of a block, each once."""
        if len(docs_of) == 0 or len(keys_of) == 0:
            return
        texts = _unpack(docs_of["z"])
        rids = docs_of["rid"].to_numpy()
        rids_at, at, keys = find_anchors(rids, texts, length)
        value, gone = keys_of["key"].to_numpy(), keys_of["gone"].to_numpy(bool)
        mine = np.isin(keys, value[~gone]) & ~np.isin(rids_at, value[gone])
        text_of = dict(zip(rids.tolist(), texts))
        for r, x in sorted(set(zip(rids_at[mine].tolist(), at[mine].tolist()))):
            yield r, x, text_of[r]

    def sort_runs(docs_of: pd.DataFrame, keys_of: pd.DataFrame) -> pd.DataFrame:
        press = zstandard.ZstdCompressor(level=1)
        held = [(raw[x:x + length], raw[max(0, x - (length - k)):x], r, x) for r, x, raw in at_chosen(docs_of, keys_of)]
        held.sort()
        firsts = [s[0][:k] for s in held]
        ends = [bisect_left(firsts, c) for c in cuts] + [len(held)]
        out, lo = [], 0
        for place, hi in enumerate(ends):
            dealt = {0: held[lo:hi]} if hi > lo else {}
            if deal > 1:
                dealt = {}
                for s in held[lo:hi]:
                    dealt.setdefault(zlib.crc32(s[0][:k]) % deal, []).append(s)
            for rest_of, some in dealt.items():
                part = place * deal + rest_of
                shared, rest = front_code([s[0] for s in some])
                out.append((part, shared.tobytes(), np.array([len(x) for x in rest], np.uint16).tobytes(),
                            np.array([len(s[1]) for s in some], np.uint16).tobytes(),
                            press.compress(b"".join(rest) + b"".join([s[1] for s in some])),
                            np.array([s[2] for s in some], np.int64).tobytes(),
                            np.array([s[3] for s in some], np.int64).tobytes()))
            lo = hi
        trim()
        return pd.DataFrame(out, columns=["part", "shared", "rest", "left", "z", "rid", "at"])

    def merge_range(group: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor()
        runs, lefts_of, rid_of, at_of = [], [], [], []
        for r in group.itertuples(index=False):
            shared, rest, left = (np.frombuffer(x, np.uint16).tolist() for x in (r.shared, r.rest, r.left))
            data, p, strings, last = unpack.decompress(r.z), 0, [], b""
            for h, size in zip(shared, rest):
                last = last[:h] + data[p:p + size]
                strings.append(last)
                p += size
            lefts = []
            for size in left:
                lefts.append(data[p:p + size])
                p += size
            runs.append((strings, shared))
            lefts_of.append(lefts)
            rid_of.append(np.frombuffer(r.rid, np.int64))
            at_of.append(np.frombuffer(r.at, np.int64))
        order, shared = merge(runs)
        del runs
        base = np.cumsum([0] + [len(x) for x in rid_of])
        flat = np.array([base[run] + row for run, row in order], np.int64)
        flags = repeated_windows(np.array(shared, np.int64), [lefts_of[run][row] for run, row in order], length)
        rid, at = np.concatenate(rid_of)[flat], np.concatenate(at_of)[flat]
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)  # one past the last d of the run of windows
        return pd.DataFrame({"rid": rid[row], "lo": at[row] - (end - 1), "hi": at[row] - first + length})

    blocks = rows.select("rid", "block", "z").groupBy("block")
    gone = copies.where("rid != one").select("block", "rid", F.lit(True))

    def keys_by_block(which: str):
        """The chosen anchors of each block, and the rows left out (``gone``: key is a rid)."""
        return chosen.where(which).select("block", "key", F.lit(False).alias("gone")).union(gone).groupBy("block")

    runs = blocks.cogroup(keys_by_block("not hot")).applyInPandas(
        sort_runs, "part int, shared binary, rest binary, left binary, z binary, rid binary, at binary")
    spans = runs.groupBy("part").applyInPandas(merge_range, "rid bigint, lo bigint, hi bigint").union(
        copies.select("rid", F.lit(0).cast("bigint").alias("lo"), F.col("size").alias("hi")))

    if not chosen.where("hot").isEmpty():
        def windows(docs_of: pd.DataFrame, keys_of: pd.DataFrame) -> pd.DataFrame:
            los = sorted({(r, lo) for r, x, raw in at_chosen(docs_of, keys_of)
                          for lo in range(max(0, x - (length - k)), x + 1) if lo + length <= len(raw)})
            texts = dict(zip(docs_of["rid"].tolist(), _unpack(docs_of["z"]))) if los else {}
            return pd.DataFrame({"w": [hashlib.blake2b(texts[r][lo:lo + length], digest_size=16).digest() for r, lo in los],
                                 "rid": [r for r, _ in los], "lo": [lo for _, lo in los]})

        # equal windows have equal anchors, so a window at a hot anchor only meets others at that anchor
        each = land(blocks.cogroup(keys_by_block("hot")).applyInPandas(
            windows, "w binary, rid bigint, lo bigint"), "suffix-windows")
        many_times = each.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w")
        spans = spans.union(each.join(many_times, "w").select("rid", "lo", (F.col("lo") + length).alias("hi")))
    return spans


def _removed(raw: bytes, los, his) -> tuple[bytes, int, int]:
    """(kept bytes, removed bytes, removed runs)."""
    if los is None or len(los) == 0:
        return raw, 0, 0
    order = np.argsort(los, kind="stable")
    kept, end, gone, runs = [], 0, 0, 0
    stop = -1
    for lo, hi in zip(np.asarray(los)[order].tolist(), np.asarray(his)[order].tolist()):
        if lo > stop:
            if stop >= 0:
                gone += stop - begin
                end = stop
            kept.append(raw[end:lo])
            begin, stop, runs = lo, hi, runs + 1
        else:
            stop = max(stop, hi)
    gone += stop - begin
    kept.append(raw[stop:])
    return b"".join(kept), gone, runs


def _finish(rows: DataFrame, spans: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256 and kept (the
    text left; bytes of characters cut in the middle dropped) of every row."""

    def finish(docs_of: pa.Table, spans_of: pa.Table) -> pa.Table:
        rid = spans_of["rid"].to_numpy()
        order = np.argsort(rid, kind="stable")
        rid, lo, hi = rid[order], spans_of["lo"].to_numpy()[order], spans_of["hi"].to_numpy()[order]
        out = []
        for r, raw in zip(docs_of["rid"].to_pylist(), _unpack(docs_of["z"].to_pylist())):
            a, b = np.searchsorted(rid, r), np.searchsorted(rid, r, "right")
            kept, gone, runs = _removed(raw, lo[a:b], hi[a:b])
            out.append((len(raw), gone, runs, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
        got = docs_of.select(keep)
        for k, (name, kind) in enumerate((("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                                          ("kept_sha256", pa.string()), ("kept", pa.string()))):
            got = got.append_column(name, pa.array([x[k] for x in out], kind))
        return got

    fields = [f for c in keep for f in rows.schema.fields if f.name == c]
    schema = StructType(fields)
    for name in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(name, LongType())
    schema = schema.add("kept_sha256", StringType()).add("kept", StringType())
    by_block = spans.select(F.shiftright("rid", BLOCK_BITS).alias("block"), "rid", "lo", "hi").groupBy("block")
    return rows.select(*keep, "rid", "block", "z").groupBy("block").cogroup(by_block).applyInArrow(finish, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   hot: int = HOT) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, kept."""
    rows = stored(docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).alias("text")), "text")
    return _finish(rows, repeated_spans(rows, length, hot), [id_col])


def cut_texts(docs: DataFrame, text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """``docs`` (``n_chars`` renewed, where there is one) without the repeated
    passages; rows of which nothing is left go, rows that were empty stay."""
    # the rest of the row travels as one struct, so no column's name can clash with those used here, and the text once
    rows = stored(docs.select(bundled(docs, text_col).alias("row"), F.col(text_col).alias("text")), "text")
    out = _finish(rows, repeated_spans(rows, length, hot), ["row", "_null"]).where("n_removed = 0 or kept != ''")
    value = {text_col: F.when(~F.col("_null"), F.col("kept"))}
    if "n_chars" in docs.columns:
        value["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("kept")) \
            .cast(docs.schema["n_chars"].dataType)
    return out.select(*[value[c].alias(c) if c in value else F.col("row").getField(c).alias(c) for c in docs.columns])


def op6_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
