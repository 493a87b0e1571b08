"""Byte-level BPE ids of whole texts, from units that are encoded once and kept.

The public vocabulary exists for two libraries; both give the same ids for
ordinary text.  A text is cut at single spaces between two non-space
characters, which are always pre-token boundaries, so the ids of a text are the
ids of its units in order and a unit's ids can be kept from text to text.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from functools import lru_cache

#: Two white-space characters in a row: then a space may belong to a run.
_RUN = re.compile(r"\s\s")
_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
#: Beyond these ranges the json file's own library encodes the unit, as the two
#: libraries may know different Unicode versions.
_RARE = re.compile("[^\u0000-ԯ‐-›€]")
#: Kept units per process: bounds a worker's memory; others are encoded again.
MAX_UNITS = 400_000
MAX_UNIT_CHARS = 48


class _Units(dict):
    """unit without its leading space -> little-endian 32-bit ids of ' ' + unit."""

    def __init__(self, encode) -> None:
        super().__init__()
        self._encode = encode

    def __missing__(self, unit: str) -> bytes:
        ids = self._encode(" " + unit)
        if len(unit) <= MAX_UNIT_CHARS and len(self) < MAX_UNITS:
            self[unit] = ids
        return ids


class ByteBpe:
    """``ids(text)``: the text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, json_path: str, ranks_path: str | None = None) -> None:
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(json_path)
        self._special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        self._ranks = None
        if ranks_path and os.path.exists(ranks_path):
            import tiktoken
            from public_tokenizers import PATTERN

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self._ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._units = _Units(self._unit)

    def _unit(self, text: str) -> bytes:
        if self._ranks is None or _RARE.search(text):
            return self._own(text)
        return array("I", self._ranks.encode_ordinary(text)).tobytes()

    def _own(self, text: str) -> bytes:
        return array("I", self._whole.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self._special):
            return self._own(text)
        units = _BOUNDARY.split(text) if _RUN.search(text) else text.split(" ")
        first = self._unit(units[0]) if units[0] else b""
        del units[0]
        return first + b"".join(map(self._units.__getitem__, units))


@lru_cache(maxsize=4)
def byte_bpe(json_path: str, ranks_path: str | None = None) -> ByteBpe:
    """One encoder per worker process and vocabulary."""
    return ByteBpe(json_path, ranks_path)
