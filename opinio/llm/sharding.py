"""Consistent sharding by a permutation-filled lookup table.

Every shard has its own order of the table's slots, (offset + j * skip) mod m with m
prime. The shards take turns; at its turn a shard claims the first slot of its
order that is still free, until the table is full. Shards then hold equal
numbers of slots (they differ by one at most), and adding or removing a shard moves
few slots. A row's key hashes to a slot; the broadcast table names the shard.

The table depends on the shard names alone and has ``slots`` rows (a fixed bound);
its turns are ``slots`` steps over those parameters, without any data. Placement is one hash and one broadcast lookup
per row, without any shuffle, so no key can be hot.

Edge cases. A NULL key hashes as the empty string. Repeated rows go to the same
shard. An empty table gives an empty result; extra columns are kept out of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm.common import ship, table

ship(__name__)

SLOTS = 4093  # prime; over a hundred slots a shard
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


def hash60(text: Column) -> Column:
    """60-bit number from the first 15 hexadecimal digits of the MD5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def fill(shards: Sequence[str], slots: int) -> list[int]:
    """slot -> place of its shard in ``shards``; depends on these parameters
    alone, and takes ``slots`` turns."""
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be prime, so that every order visits all slots")
    if not shards:
        raise ValueError("at least one shard is needed")
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    order = [(number(s + "/offset") % slots, number(s + "/skip") % (slots - 1) + 1) for s in shards]
    taken, following = [-1] * slots, [0] * len(shards)
    for turn in range(slots):
        who = turn % len(shards)
        offset, skip = order[who]
        while taken[slot := (offset + following[who] * skip) % slots] >= 0:
            following[who] += 1
        taken[slot] = who
    return taken


def lookup_table(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot int, shard int): ``slots`` rows; ``shard`` is the place in ``shards``."""
    table_of = ",".join(map(str, fill(shards, slots)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(table_of), ",").cast("array<int>")).alias("slot", "shard"))


def place(df: DataFrame, key: Column, lookup: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``, which replace columns of these names."""
    slot = F.pmod(hash60(F.coalesce(key.cast("string"), F.lit(""))), F.lit(slots)).cast("int")
    kept = [df[f"`{c}`"] for c in df.columns if c not in ("slot", "shard")]
    return df.select(*kept, slot.alias("slot")).join(F.broadcast(lookup), "slot")


def op5_lookup_table_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return place(docs, F.col("doc_id"), lookup_table(spark)).select("doc_id", "slot", "shard")


_NAMES = ", ".join(f"'{s}'" for s in SHARDS)
_H = "('0x' || substr(md5({}), 1, 15))::BIGINT"
#: The turns as a recursion over (turn, claimed slots).
ORACLE = f"""
WITH RECURSIVE o AS MATERIALIZED (
  SELECT i AS shard, {_H.format("s || '/offset'")} % {SLOTS} AS off, {_H.format("s || '/skip'")} % {SLOTS - 1} + 1 AS skip
  FROM (SELECT unnest([{_NAMES}]) AS s, unnest(range({len(SHARDS)})) AS i)),
lists AS MATERIALIZED (
  SELECT list(slots ORDER BY shard) AS l
  FROM (SELECT shard, list((off + j * skip) % {SLOTS} ORDER BY j) AS slots FROM o, range({SLOTS}) q(j) GROUP BY shard)),
turns AS (
  SELECT 0 AS t, []::BIGINT[] AS claimed
  UNION ALL
  SELECT t + 1, list_append(claimed, list_filter(l[t % {len(SHARDS)} + 1], lambda s: NOT list_contains(claimed, s))[1])
  FROM turns, lists WHERE t < {SLOTS}),
tab AS MATERIALIZED (
  SELECT unnest(claimed)::INTEGER AS slot, unnest(range({SLOTS})) % {len(SHARDS)} AS shard FROM turns WHERE t = {SLOTS})
SELECT doc_id, slot, shard::INTEGER AS shard
FROM (SELECT doc_id, ({_H.format("coalesce(doc_id::VARCHAR, '')")} % {SLOTS})::INTEGER AS slot FROM documents)
JOIN tab USING (slot)
"""
