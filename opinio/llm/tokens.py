"""Byte-level BPE ids of whole texts by way of remembered pieces.

A text is cut at places where the tokeniser's own word splitting always cuts,
so the ids of the text are the ids of its pieces in order and each distinct
piece needs encoding once.
"""

from __future__ import annotations

import os
import re

import numpy as np

from opinio.llm.common import ship, worker_cache

ship(__name__)

SPECIAL = "<|endoftext|>"
_SPACE = " \t\n\r\x0b\x0c\x85\xa0  -     　"
# white space beside white space, or white space or a sign before one of the cut signs (the tokeniser takes
# ' .' as one word): cut at white space only
_AWKWARD = re.compile(f"[{_SPACE}][{_SPACE}.,]|[^\\w{_SPACE}][.,]|[\x00\x1c-\x1f]|_[.,]")
_RUNS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_RARE = re.compile("[^\x00-ɏ]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(text: str) -> list[str]:
    """Cut a text (without special tokens inside) into independent pieces."""
    if not text:
        return []
    if _AWKWARD.search(text):
        return _RUNS.findall(text)
    return (text.replace(" ", "\x00 ").replace("\n", "\x00\n").replace(",", "\x00,").replace(".", "\x00.")
            .lstrip("\x00").split("\x00"))


def text_pieces(text: str | None) -> list[str]:
    """Pieces of any text; a special token's string is a piece of its own."""
    if not text:
        return []
    if SPECIAL not in text:
        return pieces(text)
    out: list[str] = []
    for k, part in enumerate(text.split(SPECIAL)):
        if k:
            out.append(SPECIAL)
        out += pieces(part)
    return out


def once(kind: str, path: str, make):
    """``make(path)``, kept by the Python worker."""
    held = worker_cache()
    if (kind, path) not in held:
        held[kind, path] = make(path)
    return held[kind, path]


def tokenizer(path: str):
    return once("tokenizer", path, _tokenizer)


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def piece_bytes(path: str) -> list[bytes]:
    return once("pieces", path, _piece_bytes)


def _piece_bytes(path: str) -> list[bytes]:
    """id -> bytes, from the tokeniser's vocabulary (its size bounds the list)."""
    t = tokenizer(path)
    # byte-level alphabet: printable bytes stand for themselves, the rest follow from U+0100 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain}
    back |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}
    out = [b""] * t.get_vocab_size()
    for piece, i in t.get_vocab().items():
        out[i] = piece.encode() if piece == SPECIAL else bytes(back[c] for c in piece)
    return out


def encode_words(words: list[str], path: str) -> list[np.ndarray]:
    """ids of each word, as little-endian uint32."""
    return [np.array(e.ids, "<u4") for e in tokenizer(path).encode_batch(words, add_special_tokens=False)]


class PieceIds(dict):
    """piece -> its ids as little-endian uint32 bytes; encoded on first sight and
    remembered up to a bound."""

    def __init__(self, path: str, bound: int = 300_000):
        super().__init__()
        self.path, self.bound = path, bound
        self.fast = once("ranks", path, _ranked)

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.bound:
            self.clear()
        if self.fast is None or piece == SPECIAL or _RARE.search(piece):
            ids = tokenizer(self.path).encode(piece, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(piece)
        self[piece] = raw = np.array(ids, "<u4").tobytes()
        return raw

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, text_pieces(text)))


def _ranked(path: str):
    """The same vocabulary in its rank form (a faster encoder for single
    words), where it lies beside the file; None otherwise."""
    ranks = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return None
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
