"""Unigram encoding and decoding with the pieces of a SentencePiece model.

Encoding is the Viterbi path over all pieces that match, found in a double-array trie over UTF-8
bytes: the segmentation with the greatest sum of log scores, the longer first piece on a tie. A
character no piece covers costs less than any piece allows and becomes its bytes' pieces. Spaces
become the white-space marker, and one marker is put in front of a text that is not empty.

Where no piece of the vocabulary carries the marker behind another character, no piece spans the
start of a word, so words are encoded one by one, and those a worker has met come from a bounded
cache. New words of a batch are solved together: the trie is walked for all of them at once.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.columns import id_and_text, pieces_by_bytes

MARKER = "▁"
BATCH_BYTES = 2 << 20
CACHED_WORDS = 300_000
TOGETHER_BYTES = 48  # longer words are solved alone
UNKNOWN_PENALTY = 10.0
_WORDS = re.compile(f"{MARKER}+[^{MARKER}]*|[^{MARKER}]+")


class DoubleArrayTrie:
    """``check[base[state] + byte + 1] == state`` where ``state`` has a child under ``byte``."""

    def __init__(self, keys: list[bytes], values: list[int]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, number in zip(keys, values):
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    value.append(-1)
                node = children[node][byte]
            value[node] = number
        used = bytearray(4 * len(children) + 1024)
        used[0] = 1
        self.base, self.check, self.value = (np.full(len(used), fill, np.int32)
                                             for fill in (0, -1, -1))
        dense = 1  # where the search for several free slots at once begins
        waiting = [(0, 0)]  # node, its slot
        for node, slot in waiting:
            self.value[slot] = value[node]
            codes = sorted(byte + 1 for byte in children[node])
            if not codes:
                continue
            tries, begin = 0, dense if len(codes) > 1 else 1
            place = used.find(0, max(begin, codes[0] + 1))
            while any(used[place + code - codes[0]] for code in codes[1:]):
                tries += 1
                place = used.find(0, place + 1)
            if tries > 100:
                dense = max(dense, place - codes[0])
            start = place - codes[0]
            self.base[slot] = start
            for code in codes:
                used[start + code] = 1
                self.check[start + code] = slot
                waiting.append((children[node][code - 1], start + code))
        end = used.rfind(1) + 258
        if end > len(used):
            raise ValueError("the trie outgrew its slots")
        self.base, self.check, self.value = (x[:end].copy() for x in
                                             (self.base, self.check, self.value))

    def prefixes(self, text: bytes, start: int) -> Iterator[tuple[int, int]]:
        """``(end, value)`` of every key that lies at ``start``, shortest first."""
        slot = 0
        for end in range(start, len(text)):
            below = int(self.base[slot]) + text[end] + 1
            if not self.base[slot] or self.check[below] != slot:
                return
            slot = below
            if self.value[slot] >= 0:
                yield end + 1, int(self.value[slot])


def _width(lead: np.ndarray) -> np.ndarray:
    """Bytes of the character that begins with ``lead``."""
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


class Unigram:
    """Encoder and decoder over the pieces and scores of a model file."""

    def __init__(self, path: str, scores: list[float] | None = None):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.score = np.array(scores or [model.get_score(i) for i in range(size)], np.float64)
        self.byte_id = np.full(256, model.unk_id(), np.int32)
        self.byte_of: dict[int, int] = {}
        normal = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
                self.byte_of[i] = int(name[3:5], 16)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                normal.append(i)
        self.trie = DoubleArrayTrie([names[i].encode() for i in normal], normal)
        self.unknown = float(self.score[normal].min()) - UNKNOWN_PENALTY
        self.by_word = not any(MARKER in names[i].lstrip(MARKER) for i in normal)
        hidden = {i for i in range(size) if model.is_control(i)}
        self.surface = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in hidden
                        else name.replace(MARKER, " ").encode() for i, name in enumerate(names)]
        self.cache: dict[str, bytes] = {}

    def solve(self, text: bytes) -> list[int]:
        """The best path of one string of any length."""
        best, came = [float("-inf")] * (len(text) + 1), [(0, -1)] * (len(text) + 1)
        best[0] = 0.0
        start = 0
        while start < len(text):
            here, width = best[start], int(_width(np.uint8(text[start])))
            single = False
            for end, piece in self.trie.prefixes(text, start):
                single |= end - start == width
                if here + self.score[piece] > best[end]:
                    best[end], came[end] = here + self.score[piece], (start, piece)
            if not single and here + self.unknown > best[start + width]:
                best[start + width], came[start + width] = here + self.unknown, (start, -1)
            start += width
        out, end = [], len(text)
        while end:
            start, piece = came[end]
            out += [piece] if piece >= 0 else [int(self.byte_id[b]) for b in text[start:end][::-1]]
            end = start
        return out[::-1]

    def solve_many(self, texts: list[bytes]) -> list[bytes]:
        """Best paths of many short strings as little-endian int32 ids."""
        if not texts:
            return []
        lengths = np.array([len(t) for t in texts])
        order = np.argsort(-lengths, kind="stable")
        texts, lengths = [texts[k] for k in order], lengths[order]
        longest = int(lengths[0])
        codes = np.zeros((len(texts), longest + 4), np.int32)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        codes[:, :longest][np.arange(longest) < lengths[:, None]] = flat
        best = np.full((len(texts), longest + 4), -np.inf)
        best[:, 0] = 0.0
        back = np.zeros((len(texts), longest + 4), np.int32)
        piece_at = np.full((len(texts), longest + 4), -1, np.int32)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for start in range(longest):
            rows = np.flatnonzero(np.isfinite(best[:np.searchsorted(-lengths, -start), start]))
            if not len(rows):
                continue
            width = _width(codes[rows, start])
            single = np.zeros(len(rows), bool)
            place, slot, walk = np.arange(len(rows)), np.zeros(len(rows), np.int32), rows
            for end in range(start, longest):
                keep = (lengths[walk] > end) & (base[slot] > 0)
                below = base[slot] + codes[walk, end] + 1
                keep &= check[below] == slot
                place, walk, slot = place[keep], walk[keep], below[keep]
                if not len(walk):
                    break
                found = np.flatnonzero(value[slot] >= 0)
                if len(found):
                    at, pieces = walk[found], value[slot[found]]
                    single[place[found]] |= width[place[found]] == end + 1 - start
                    total = best[at, start] + self.score[pieces]
                    win = total > best[at, end + 1]
                    at, pieces = at[win], pieces[win]
                    best[at, end + 1], back[at, end + 1] = total[win], start
                    piece_at[at, end + 1] = pieces
            lone, wide = rows[~single], width[~single]
            total = best[lone, start] + self.unknown
            win = total > best[lone, start + wide]
            lone, wide = lone[win], wide[win]
            best[lone, start + wide], back[lone, start + wide] = total[win], start
            piece_at[lone, start + wide] = -1
        out = [b""] * len(texts)
        back, piece_at = back.tolist(), piece_at.tolist()
        for k, text in enumerate(texts):
            end, ids, froms, pieces = len(text), [], back[k], piece_at[k]
            while end:
                start = froms[end]
                if pieces[end] >= 0:
                    ids.append(pieces[end])
                else:
                    ids += [int(self.byte_id[b]) for b in text[start:end][::-1]]
                end = start
            out[order[k]] = np.array(ids[::-1], "<i4").tobytes()
        return out

    def words(self, text: str) -> list[str]:
        """``text`` with markers, cut where no piece can span the cut."""
        if not text:
            return []
        marked = MARKER + text.replace(" ", MARKER)
        if not self.by_word:
            return [marked]
        if "  " in text or MARKER in text or text[0] == " ":
            return _WORDS.findall(marked)
        return [MARKER + word for word in text.split(" ")]

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.words(text) for text in texts]
        known = set().union(*cut)
        new = [word for word in known if word not in self.cache]
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = list(known)
        raw = [word.encode() for word in new]
        short = [k for k, word in enumerate(raw) if len(word) <= TOGETHER_BYTES]
        found = self.cache if len(new) <= CACHED_WORDS else dict(self.cache)
        for k, ids in zip(short, self.solve_many([raw[k] for k in short])):
            found[new[k]] = ids
        long = {new[k]: np.array(self.solve(word), "<i4").tobytes()
                for k, word in enumerate(raw) if len(word) > TOGETHER_BYTES}
        get = (found | long if long else found).__getitem__
        return [np.frombuffer(b"".join(map(get, words)), "<i4") for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``: byte pieces are joined to characters, markers become spaces, and
        the marker that encoding put in front goes. Broken UTF-8 decodes to U+FFFD."""
        text = b"".join(map(self.surface.__getitem__, ids.tolist()))
        return text[text[:1] == b" ":].decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    return Unigram(path)


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` for every row; a null or empty text has no ids.

    Equal, null and repeated ids are kept row by row; an empty table gives an empty result; other
    columns are not read.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches):
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            ids = unigram(path).encode_batch(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                names=["doc_id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` for every row of ids; null or empty ids give the empty text, null ids
    inside a list are skipped."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches):
        for batch in batches:
            texts = [unigram(path).decode(np.array([i for i in ids or [] if i is not None], int))
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    chosen = encoded.select(encoded[id_col].cast("long").alias("doc_id"),
                            encoded[ids_col].alias("ids"))
    return chosen.mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encodes and decodes every row without moving ids out of the worker.

    ``doc_id, n_ids, ids_crc32`` (unsigned, over little-endian 32-bit ids), ``decoded`` and
    ``lossless`` (the decoded text is the text). Only a text with U+2581 of its own can come back
    changed: decoding makes it a space. Nulls and empties as in :func:`encode`.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches):
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            model, texts = unigram(path), batch.column("text").to_pylist()
            ids = model.encode_batch(texts)
            back = [model.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                 pa.array(back, pa.string()),
                 pa.array([a == b for a, b in zip(texts, back)], pa.bool_())],
                names=["doc_id", "n_ids", "ids_crc32", "decoded", "lossless"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, decoded string, lossless boolean")


def digests(docs: DataFrame, **options) -> DataFrame:
    """:func:`round_trip` with the decoded text as its SHA-256."""
    return round_trip(docs, **options).withColumn(
        "decoded_sha256", F.sha2("decoded", 256)).drop("decoded")
