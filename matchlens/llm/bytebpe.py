"""Byte-level BPE ids of whole texts, with the words met before taken from a bounded cache.

The pattern of byte-level BPE starts a new word at each single space before a visible character.
Cutting there and encoding the cuts one by one therefore gives the ids of the whole text.
"""

from __future__ import annotations

import functools
import json
import re
from array import array

import numpy as np
import public_tokenizers

CACHED_WORDS = 500_000
CACHED_WORD_CHARS = 64
LONG_WORD_CHARS = 4096  # runs of letters or white space that the rank encoder is not given
_BLANK_AFTER_SPACE = re.compile(r" (?:\s|\Z)")
_WORD_START = re.compile(r" (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class _Words(dict):
    """Little-endian 32-bit ids of ``" " + word``; words not met yet are encoded and kept."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("i", self.encode(" " + word)).tobytes()
        if len(word) <= CACHED_WORD_CHARS:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


class ByteBpe:
    """Encodes texts as ``tokenizers`` does with ``add_special_tokens=False``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        settings = json.loads(self.library.to_str())
        pre = settings["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or settings["normalizer"]:
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        self.special = [token["content"] for token in settings["added_tokens"]]
        alphabet = byte_alphabet()
        added = {token["id"] for token in settings["added_tokens"]}
        self.pieces = {i: bytes(map(alphabet.__getitem__, piece))
                       for piece, i in settings["model"]["vocab"].items() if i not in added}
        self._encode = self._ranked(settings)
        self.words = _Words(self._encode)
        size = max([*self.pieces, *added]) + 1
        self.ends, self.starts = np.zeros(size, bool), np.zeros(size, bool)
        for i, piece in self.pieces.items():
            self.ends[i] = piece[-1:] in (b".", b"!", b"?", b"\n")
            self.starts[i] = piece[:1] in (b" ", b"\n")

    def _ranked(self, settings):
        """A rank encoder of the same vocabulary, where the merges come in the order of the ids;
        otherwise the library itself. The former costs a quarter on single words."""
        vocab, merges = settings["model"]["vocab"], settings["model"]["merges"]
        joined = [vocab["".join(pair if isinstance(pair, list) else pair.split(" "))]
                  for pair in merges]
        if joined == sorted(joined) and min(joined, default=0) >= 256:
            import tiktoken

            ranks = {piece: i for i, piece in self.pieces.items()}
            encoding = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=ranks, special_tokens={})
            # Its pattern matcher recurses over runs; the library's own takes any length.
            return lambda text: (encoding.encode_ordinary(text) if len(text) <= LONG_WORD_CHARS
                                 else self._by_library(text))
        return self._by_library

    def _by_library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text`` as int32."""
        if any(content in text for content in self.special):
            return np.array(self._by_library(text), np.int32)
        if not text:
            return np.zeros(0, np.int32)
        words = _WORD_START.split(text) if _BLANK_AFTER_SPACE.search(text) else text.split(" ")
        first = array("i", self._encode(words[0])).tobytes()
        return np.frombuffer(first + b"".join(map(self.words.__getitem__, words[1:])), "<i4")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    return ByteBpe(path)
