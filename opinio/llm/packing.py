"""Hierarchical multi-length packing of documents into training sequences.

Every input partition is a packing domain of its own, so nothing is shuffled
and no group can grow hot. Inside a domain, bounded buffers of documents go
through the same steps:

1. cut whole 2048-token windows off long documents;
2. route each remainder to the smallest context tier (256, 512, 1024, 2048)
   that holds it;
3. pack each tier from the longest: a window starts with a segment of its
   tier, its gap is filled best-fit with segments of shorter tiers, and what no
   whole segment fits is filled by cutting one, so the window is full;
4. windows of a tier form step groups of equal token totals.

A domain's last leftovers are cut into full power-of-two windows, so no
sequence is padded at all.

Edge cases. NULL or empty text: the end token alone. A very long text becomes
many windows. Repeated rows are packed once each. A NULL doc_id is carried
through. An empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import ship, table
from opinio.llm.tokens import PieceIds, default_path

ship(__name__)

MAX_LEN = 2048
TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16 * 2048
END_ID = 1
BUFFER_TOKENS = 4_000_000

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, tier int, step_group bigint")


class Packer:
    """Packs segments (length, doc, start) of one domain; ``emit`` gets windows."""

    def __init__(self, tiers: tuple[int, ...], emit):
        self.tiers, self.emit = tiers, emit
        self.pools: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}

    def add(self, length: int, doc: int, start: int) -> None:
        top = self.tiers[-1]
        while length >= top:
            self.emit(top, [(top, doc, start)])
            length, start = length - top, start + top
        if length:
            insort(self.pools[next(t for t in self.tiers if t >= length)], (length, doc, start))

    def _fill(self, gap: int, below: list[int]) -> list[tuple[int, int, int]]:
        """Whole segments of the tiers ``below``, best fit first; then a cut one."""
        got = []
        while gap:
            best = None
            for t in below:
                k = bisect_right(self.pools[t], (gap, float("inf"), 0)) - 1
                if k >= 0 and (best is None or self.pools[t][k][0] > best[2]):
                    best = t, k, self.pools[t][k][0]
            if best:
                got.append(self.pools[best[0]].pop(best[1]))
                gap -= best[2]
                continue
            donor = next((t for t in reversed(below) if self.pools[t]), None)
            if donor is None:
                return got
            length, doc, start = self.pools[donor].pop()
            got.append((gap, doc, start))
            self.add(length - gap, doc, start + gap)
            gap = 0
        return got

    def pack(self, last: bool) -> None:
        """Pack each tier, longest first; segments that cannot fill a window
        wait for the next buffer unless it is the ``last``."""
        for k in range(len(self.tiers) - 1, -1, -1):
            tier, pool = self.tiers[k], self.pools[self.tiers[k]]
            below = list(self.tiers[:k + 1])
            while pool:
                if sum(s[0] for t in below for s in self.pools[t][-64:]) < tier:
                    break  # too little left to fill a window of this tier
                head = pool.pop()
                got = [head, *self._fill(tier - head[0], below)]
                if sum(s[0] for s in got) < tier:
                    for s in got:
                        self.add(*s)
                    break
                self.emit(tier, got)
        if last:
            rest = [s for t in self.tiers for s in self.pools[t]]
            self.pools = {t: [] for t in self.tiers}
            left = sum(s[0] for s in rest)
            while left:
                size = min(self.tiers[-1], 1 << (left.bit_length() - 1))
                left -= size
                got, need = [], size
                while need:
                    length, doc, start = rest.pop()
                    take = min(length, need)
                    got.append((take, doc, start))
                    if take < length:
                        rest.append((length - take, doc, start + take))
                    need -= take
                self.emit(size, got)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                   tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, end_id: int = END_ID,
                   buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """One row per piece: which tokens of which document lie where in which
    sequence, with the tier and the step group of the sequence. ``tiers`` are
    powers of two, ascending."""
    path = path or default_path()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        ids = PieceIds(path)
        docs_held: dict[int, tuple[int | None, bytes]] = {}
        out: list[tuple] = []
        state = {"seq": 0, "doc": 0, "group": 0}
        filling: dict[int, list[int]] = {}

        def emit(tier: int, segments) -> None:
            group = filling.get(tier)
            if group is None or group[1] + tier > step_tokens:
                group = filling[tier] = [state["group"], 0]
                state["group"] += 1
            group[1] += tier
            offset = 0
            for length, doc, start in segments:
                name, raw = docs_held[doc]
                out.append((name, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), len(raw) // 4,
                            base + state["seq"], offset, tier, base + group[0]))
                offset += length
            state["seq"] += 1

        packer = Packer(tiers, emit)

        def flush() -> pd.DataFrame:
            frame = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                               "offset", "tier", "step_group"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            out.clear()
            waiting = {s[1] for pool in packer.pools.values() for s in pool}
            for k in [k for k in docs_held if k not in waiting]:
                del docs_held[k]
            return frame

        held = 0
        for batch in batches:
            for name, text in zip(batch["id"], batch["text"]):
                raw = ids.encode(text) + end
                k = state["doc"]
                state["doc"] += 1
                docs_held[k] = (None if pd.isna(name) else int(name), raw)
                packer.add(len(raw) // 4, k, 0)
                held += len(raw) // 4
                if held >= buffer_tokens:
                    packer.pack(last=False)
                    yield flush()
                    held = 0
        packer.pack(last=True)
        yield flush()

    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    out = src.mapInPandas(run, SCHEMA)
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)


def op2_hierarchical_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
