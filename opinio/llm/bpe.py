"""BPE encoding and decoding through a distinct-word table.

1. Every task splits the words of its documents (at places where the
   tokeniser itself always cuts) and hands on each block's distinct words;
   a block is about 16 MB of text of one input partition. The words go out in sorted lists, one for each
   of BUCKETS hash values, compressed: a row a block and bucket.
2. The lists are shuffled by bucket and read in its order; each distinct word of a bucket is
   encoded once, whatever number of blocks holds it.
3. The ids go back as lists of the same order, by block, where they meet the block's
   documents: ids of the document = ids of its words in order. Decoding joins
   the ids of each of the block's words with the id-to-piece table (50,257 rows, a
   fixed bound) and puts the pieces together.

No row exists per word occurrence and documents travel once, compressed, a very long one as a block of its own.
Should a block be formed differently on a second reading (an input without a
stable order), its unknown words are encoded on the spot, so the result stays
exact.

Edge cases. NULL or empty text: no ids, digests of the empty string. The
special token's string in a text is its special id, as the library has
it. Repeated rows give repeated results; a NULL doc_id is carried through; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import ship, table
from opinio.llm.tokens import default_path, encode_words, once, piece_bytes, text_pieces

ship(__name__)

BLOCK_BYTES = 16 << 20
BUCKETS = 1024
MOST_WORDS = 1_000_000  # words an encoding task remembers at once


def _in_blocks(batches: Iterator[pd.DataFrame], block_bytes: int) -> Iterator[tuple[int, list, list]]:
    """(block, ids, texts) of one task."""
    base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
    block, ids, texts, held = 0, [], [], 0
    for batch in batches:
        for i, t in zip(batch["id"], batch["text"]):
            ids.append(i)
            texts.append(t)
            held += len(t or "")
            if held >= block_bytes:
                yield base + block, ids, texts
                block, ids, texts, held = block + 1, [], [], 0
    if ids:
        yield base + block, ids, texts


def _words(texts: list) -> list[str]:
    seen: set[str] = set()
    for t in texts:
        seen.update(text_pieces(t))
    return sorted(seen)


def _bucketed(words: list[str]) -> dict[int, list[int]]:
    """bucket -> places in ``words`` (sorted) of its words."""
    out: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        out.setdefault(zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS, []).append(k)
    return out


def _packed(parts: list[bytes], press) -> bytes:
    """Byte strings as one compressed string."""
    sizes = np.array([len(p) for p in parts], "<u4")
    return press.compress(np.array([len(parts)], "<u4").tobytes() + sizes.tobytes() + b"".join(parts))


def _unpacked(z: bytes, unpack) -> list[bytes]:
    raw = unpack.decompress(z)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4))).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


def _lookups(words: list[str], raw_of: list[bytes | None], path: str) -> tuple[dict[str, str], dict[str, bytes]]:
    """word -> its ids, each followed by a comma; word -> its decoded bytes."""
    def encoded(some: list[str]) -> list[bytes]:
        return [b"\xff" + x.tobytes() for x in encode_words(some, path)]

    missing = [k for k, raw in enumerate(raw_of) if raw is None]
    for k, raw in zip(missing, encoded([words[k] for k in missing])):
        raw_of[k] = raw
    piece = piece_bytes(path)
    text = once("id texts", path, lambda _: [f"{i}," for i in range(len(piece))])
    ids_of, bytes_of = {}, {}

    def fill(some: list[str], raws: list[bytes], sure: bool = False) -> list[str]:
        """Words whose ids do not decode to them stay out, unless ``sure``."""
        size = np.fromiter(map(len, raws), np.int64, len(raws))
        if (size % 2).any():
            parts = [np.frombuffer(r[1:], "<u4") if len(r) % 2 else np.frombuffer(r, "<u2") for r in raws]
            flat, ends = np.concatenate(parts).tolist(), np.cumsum([len(x) for x in parts]).tolist()
        else:
            flat, ends = np.frombuffer(b"".join(raws), "<u2").tolist(), np.cumsum(size // 2).tolist()
        wrong, a = [], 0
        for word, b in zip(some, ends):
            own = flat[a:b]
            got = b"".join([piece[i] for i in own])
            if sure or got == word.encode("utf-8", "surrogatepass"):
                ids_of[word], bytes_of[word] = "".join([text[i] for i in own]), got
            else:
                wrong.append(word)
            a = b
        return wrong

    moved = fill(words, raw_of)  # on a second reading in another order
    if moved:
        fill(moved, encoded(moved), sure=True)
    return ids_of, bytes_of


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                  block_bytes: int = BLOCK_BYTES, keep_ids: bool = False) -> DataFrame:
    """One row per document: n_tokens, ids_sha256, decoded_sha256; with
    ``keep_ids`` also ``ids`` (array<int>) and ``decoded`` (string)."""
    path = path or default_path()
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for block, _, texts in _in_blocks(batches, block_bytes):
            found = _words(texts)
            lists = [(b, _packed([found[k].encode("utf-8", "surrogatepass") for k in places], press))
                     for b, places in _bucketed(found).items()]
            yield pd.DataFrame({"bucket": [b for b, _ in lists], "block": block, "z": [z for _, z in lists]})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press, unpack = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        narrow = len(piece_bytes(path)) <= 1 << 16
        known: dict[bytes, bytes] = {}
        last = None
        for batch in batches:
            out = []
            for bucket, z in zip(batch["bucket"], batch["z"]):
                if bucket != last or len(known) > MOST_WORDS:
                    known, last = {}, bucket
                some = _unpacked(z, unpack)
                fresh = [w for w in some if w not in known]
                for w, x in zip(fresh, encode_words([w.decode("utf-8", "surrogatepass") for w in fresh], path)):
                    known[w] = x.astype("<u2").tobytes() if narrow else b"\xff" + x.tobytes()
                out.append(_packed([known[w] for w in some], press))
            yield pd.DataFrame({"block": batch["block"], "bucket": batch["bucket"], "z": out})

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # one row a block, with matches over its whole length: copies lie far apart
        press = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters.from_level(
            3, window_log=25, enable_ldm=True))
        for block, ids, held in _in_blocks(batches, block_bytes):
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in held]
            yield pd.DataFrame({"block": [block], "id": [[None if pd.isna(i) else int(i) for i in ids]],
                                "size": [[len(r) for r in raw]], "z": [press.compress(b"".join(raw))]})

    def assemble(key, docs_of: pd.DataFrame, words_of: pd.DataFrame) -> pd.DataFrame:
        if len(docs_of) == 0:
            return pd.DataFrame({"id": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []})
        unpack = zstandard.ZstdDecompressor()
        ids, held = [], []
        same: dict[str, str] = {}  # one object per distinct word of the block
        for row_ids, sizes, z in zip(docs_of["id"], docs_of["size"], docs_of["z"]):
            raw, at = unpack.decompress(z), 0
            for i, size in zip(row_ids, sizes):
                ids.append(i)
                split = text_pieces(raw[at:at + size].decode("utf-8", "surrogatepass"))
                held.append(list(map(same.setdefault, split, split)))
                at += size
        found = sorted(same)
        raw_of: list[bytes | None] = [None] * len(found)
        places_of = _bucketed(found)
        for bucket, z in zip(words_of["bucket"], words_of["z"]):
            raws, places = _unpacked(z, unpack), places_of.get(bucket, [])
            if len(raws) == len(places):
                for k, raw in zip(places, raws):
                    raw_of[k] = raw
        ids_of, bytes_of = _lookups(found, raw_of, path)
        out = []
        for i, split in zip(ids, held):
            text_ids = "".join(map(ids_of.__getitem__, split))[:-1]
            decoded = b"".join(map(bytes_of.__getitem__, split)).decode("utf-8", "replace")
            out.append((i, text_ids.count(",") + bool(text_ids), hashlib.sha256(text_ids.encode()).hexdigest(),
                        hashlib.sha256(decoded.encode("utf-8")).hexdigest(),
                        [int(x) for x in text_ids.split(",")] if keep_ids and text_ids else [],
                        decoded if keep_ids else ""))
        frame = pd.DataFrame(out, columns=["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"])
        frame["id"] = frame["id"].astype("Int64")
        return frame

    by_bucket = src.mapInPandas(words, "bucket int, block bigint, z binary") \
        .repartition("bucket").sortWithinPartitions("bucket")
    by_block = by_bucket.mapInPandas(encode, "block bigint, bucket int, z binary").groupBy("block")
    packed = src.mapInPandas(texts, "block bigint, id array<bigint>, size array<int>, z binary").groupBy("block")
    out = packed.cogroup(by_block).applyInPandas(
        assemble, "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids array<int>, decoded string")
    out = out.withColumnRenamed("id", id_col)
    return out if keep_ids else out.drop("ids", "decoded")


def op8_bpe_encode_decode(spark, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"))
