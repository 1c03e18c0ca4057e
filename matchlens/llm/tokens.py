"""Exact token counts without materialising tokens.

Texts reach the tokenizer in batches of equal bytes rather than equal rows. Long texts are cut at
white space, where the tokenizer cuts as well, so one document never holds a worker's memory.
Words repeat, so each worker keeps the lengths of the words it has met in a bounded cache and
sends only new words to the tokenizer, many at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.llm.columns import WORD_BREAKS, id_and_text, pieces_by_bytes

BATCH_BYTES = 4 << 20
PIECE_BYTES = 1 << 18
CACHED_WORDS = 400_000
CACHED_WORD_BYTES = 64


def safe_pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """``text`` cut into pieces of about ``size`` bytes, only next to ASCII white space.

    A run without white space that is longer than ``size`` stays whole.
    """
    start, end = 0, len(text)
    while end - start > size:
        cut = start + size
        while cut < end and text[cut] not in WORD_BREAKS:
            cut += 1
        yield text[start:cut]
        start = cut
    if start < end:
        yield text[start:]


class WordLengths(dict):
    """Tokens of each word met, for at most ``CACHED_WORDS`` words."""

    def __init__(self, count_many: Callable[[list[str]], list[int]]):
        super().__init__()
        self.count_many = count_many

    def learn(self, words: set[bytes]) -> None:
        """Adds ``words`` to the cache; what was there before may go."""
        new = [word for word in words if word not in self]
        if len(self) + len(new) > CACHED_WORDS:
            self.clear()
            new = list(words)
        self.update(zip(new, self.count_many([word.decode() for word in new])))

    def total(self, words: list[bytes]) -> int:
        return sum(map(self.__getitem__, words))


def _count_many(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """The counting function of a tokenizer file, and whether it may be fed word by word.

    Word by word is right where a tokenizer drops white space, so that no token spans it. That
    is read off the file's own pre-tokenizer; in doubt the whole piece is encoded.
    """
    if path.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in processor.encode(texts, num_threads=1)], False
    import json

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    text = tokenizer.to_str()
    settings = json.loads(text)
    steps = settings.get("pre_tokenizer") or {}
    first = (steps.get("pretokenizers") or [steps])[0]
    drops = (first.get("type") == "Split" and first.get("behavior") == "Removed"
             and first.get("invert") and "\\s" in first["pattern"].get("Regex", ""))
    added = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or set(x["content"].encode())
                     & set(WORD_BREAKS)) for x in settings["added_tokens"])
    return (lambda texts: [len(x) for x in tokenizer.encode_batch_fast(
        texts, add_special_tokens=False)]), bool(drops and added)


@functools.lru_cache(maxsize=4)
def _counter(path: str) -> tuple[Callable[[list[str]], list[int]], WordLengths | None]:
    count_many, by_word = _count_many(path)
    return count_many, WordLengths(count_many) if by_word else None


def count_batch(texts: list[bytes], path: str) -> list[int]:
    """Tokens of each text."""
    count_many, lengths = _counter(path)
    if lengths is None:  # white space matters to this tokenizer: whole texts
        return count_many([text.decode() for text in texts])
    totals = [0] * len(texts)
    held: list[tuple[int, list[bytes]]] = []
    size = 0

    def flush():
        known = set(chain.from_iterable(words for _, words in held))
        long = {word for word in known if len(word) > CACHED_WORD_BYTES}
        lengths.learn(known - long)
        own = dict(zip(long, count_many([word.decode() for word in long])))
        for row, words in held:
            if long:
                totals[row] += sum(own[w] if w in own else lengths[w] for w in words)
            else:
                totals[row] += lengths.total(words)
        held.clear()

    for row, text in enumerate(texts):
        for piece in safe_pieces(text):
            held.append((row, piece.split()))
            size += len(piece)
            if size >= BATCH_BYTES:
                flush()
                size = 0
    flush()
    return totals


def count_tokens(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    A null or empty text has no bytes and no tokens. Rows with equal or null ids are counted one
    by one, an empty table gives an empty result, and other columns are not read.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_by_bytes(batches, BATCH_BYTES):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(count_batch(texts, path), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    counted = id_and_text(docs, id_col, text_col).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
