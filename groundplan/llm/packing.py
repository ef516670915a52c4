"""Packing examples into sequences as vector bin packing with the dot-product heuristic.

Every example uses up three things of a sequence: tokens, segments (one for each piece) and loss-bearing tokens. An open
sequence takes the waiting example that fits all three limits and has the largest dot product with what is left of them,
each as a share of its limit; when nothing fits whole, the example with the largest dot product is cut so that the tokens
come out even. The loss-bearing tokens of an example are its last ones (a prompt stands first), so a cut splits them as
they lie. What remains at the end of a partition is cut at powers of two, lengths that need no padding.

Packing runs inside each input partition, with a bounded pool of waiting examples: no shuffle, nothing gathered, and a
lost task is repeated with the same result. Sequence ids hold the partition's number in their upper bits.

Defined results: a null or empty text is one token (the end token); repeated rows are packed each for itself; an empty
table has no pieces; extra columns are ignored; texts longer than a sequence are cut; of examples with equal products the
one that has waited in the lower place goes first.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from groundplan.llm import textscan
from groundplan.llm.frames import key_name, map_arrow, position
from groundplan.llm.pieces import UnitCache


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 128
    loss: int = 4096


@dataclass
class _Item:
    key: object
    ids: np.ndarray
    at: int  # the first id that is not placed yet
    prompt: int  # ids before the loss-bearing ones

    def loss(self, upto: int) -> int:
        return max(0, upto - max(self.at, self.prompt))


class Packer:
    """Places examples; `out(item, start, length, sequence, offset)` is called for each piece."""

    def __init__(self, limits: Limits, out: Callable, pool: int = 256):
        self.limits, self.out, self.size = limits, out, pool
        self.items: list[_Item] = []
        self.tokens = np.zeros(pool + 1, np.int64)
        self.losses = np.zeros(pool + 1, np.int64)
        self.sequence = 0

    def _longest(self, item: _Item, tokens: int, loss: int) -> int:
        """How many of the item's next ids go into so many tokens and loss-bearing tokens."""
        free = max(0, item.prompt - item.at)
        return min(len(item.ids) - item.at, tokens, free + loss)

    def add(self, key, ids: np.ndarray, loss: int | None = None) -> None:
        item = _Item(key, ids, 0, len(ids) - (len(ids) if loss is None else min(max(loss, 0), len(ids))))
        while len(ids) - item.at >= self.limits.tokens and self._longest(item, self.limits.tokens, self.limits.loss) == self.limits.tokens:
            self._place(item, self.limits.tokens, 0)
            self.sequence += 1
        if item.at < len(ids):
            self._wait(item)
        while len(self.items) >= self.size:
            self._fill()

    def _wait(self, item: _Item) -> None:
        n = len(self.items)
        self.items.append(item)
        self.tokens[n], self.losses[n] = len(item.ids) - item.at, item.loss(len(item.ids))

    def _place(self, item: _Item, length: int, offset: int) -> None:
        self.out(item, item.at, length, self.sequence, offset)
        item.at += length

    def _leave(self, i: int) -> None:
        last = len(self.items) - 1
        self.items[i] = self.items[last]
        self.tokens[i], self.losses[i] = self.tokens[last], self.losses[last]
        self.items.pop()

    def _fill(self) -> None:
        """Fill one sequence."""
        cap = self.limits
        tokens, segments, loss, offset = cap.tokens, cap.segments, cap.loss, 0
        while self.items and tokens and segments:
            n = len(self.items)
            t, c = self.tokens[:n], self.losses[:n]
            dot = t * (tokens / cap.tokens**2) + c * (loss / cap.loss**2) + segments / cap.segments**2
            fits = (t <= tokens) & (c <= loss)
            if fits.any():
                i = int(np.argmax(np.where(fits, dot, -1.0)))
                length = int(t[i])
            else:
                i = int(np.argmax(dot))
                length = self._longest(self.items[i], tokens, loss)
                if not length:
                    break
            item = self.items[i]
            used = item.loss(item.at + length)
            self._place(item, length, offset)
            offset, tokens, segments, loss = offset + length, tokens - length, segments - 1, loss - used
            if item.at == len(item.ids):
                self._leave(i)
            else:
                self.tokens[i], self.losses[i] = len(item.ids) - item.at, item.loss(len(item.ids))
        self.sequence += 1

    def close(self) -> None:
        """Place all that waits; the last tokens go to sequences of powers of two."""
        cap = self.limits
        while self.items:
            left = int(self.tokens[: len(self.items)].sum())
            if left >= cap.tokens:
                self._fill()
                continue
            self.limits = Limits(1 << (left.bit_length() - 1), cap.segments, cap.loss)
            self._fill()
            self.limits = cap


class WordCoder:
    """A tokenizers file whose pre-tokenizer drops white space, so that words are encoded each for itself, once.

    Only texts that hold the string of an added token, which the library finds anywhere, are encoded as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.added = re.compile("|".join(map(re.escape, added)).encode(), re.I) if added else None
        self.cache = UnitCache(lambda units: [e.ids for e in self.tokenizer.encode_batch_fast([u.decode() for u in units], add_special_tokens=False)])

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def found(self, data: np.ndarray, offs: np.ndarray) -> set[int]:
        """The texts that hold an added token's string."""
        if self.added is None:
            return set()
        return {int(np.searchsorted(offs, m.start(), "right")) - 1 for m in self.added.finditer(data)}


_coders: dict[str, WordCoder] = {}


def word_coder(path: str) -> WordCoder:
    """The coder of a file, kept by each Python worker."""
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_POINT = np.zeros(256, bool)  # ASCII that is neither letter, digit, space, control nor apostrophe
_POINT[[b for b in range(33, 127) if not _LETTER[b] and not 48 <= b < 58 and b != 39]] = True


def word_parts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and starts and ends of parts that the word tokenizer encodes each for itself.

    Words are cut where a letter and a point meet, which its pre-tokenizer does too; only letters of ASCII and U+00C0 to
    U+00FF count here, and lower case, which its normaliser gives anyway, is applied to just these.
    """
    data = data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    lead = np.zeros(len(data), bool)
    lead[1:] = data[:-1] == 0xC3
    latin = lead & (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
    data[latin & (data <= 0x9E)] += 0x20
    letter = _LETTER[data] | latin
    letter[:-1] |= latin[1:]
    point = _POINT[data]
    meet = np.flatnonzero((letter[:-1] & point[1:]) | (point[:-1] & letter[1:])) + 1
    starts, ends = textscan.spans(~textscan.SPACE[data], np.concatenate([offs, meet]))
    return data, starts, ends


def token_ids(col: pa.Array, coder: WordCoder, end: int) -> Iterator[np.ndarray]:
    """The ids of each text as the library gives them without adding special tokens, the end token last."""
    for s in textscan.slices(col):
        whole = coder.found(s.data, s.offs)
        data, starts, ends = word_parts(s.data, s.offs)
        flat, sizes = coder.cache.lookup(data, starts, ends, textscan.span_hashes(data, starts, ends))
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, s.offs)]
        for i, (a, b) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)):
            part = coder.whole(s.data[s.offs[i] : s.offs[i + 1]].tobytes().decode()) if i in whole else flat[a:b]
            ids = np.empty(len(part) + 1, "<u4")
            ids[:-1] = part
            ids[-1] = end
            yield ids


PIECES = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")])


def pack(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", end: int = 2, limits: Limits = Limits(), loss: str | None = None) -> DataFrame:
    """One row for each piece: key (as key_name says), start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    loss names a column with how many last tokens of an example bear loss (null or unnamed: all).
    """
    kind = T.StructField(key_name(key, PIECES.names), docs.schema.fields[position(docs, key)].dataType)
    chosen = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"), (F.col(f"`{loss}`") if loss else F.lit(None)).cast("long").alias("l"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(tokenizer)
        first = TaskContext.get().partitionId() << 36
        keys: list = []
        rows: list[tuple] = []

        def out(item: _Item, start: int, length: int, sequence: int, offset: int) -> None:
            keys.append(item.key)
            part = item.ids[start : start + length]
            rows.append((start, length, zlib.crc32(part.tobytes()), len(item.ids), first + sequence, offset, max(0, start + length - max(start, item.prompt))))

        def flush() -> pa.RecordBatch:
            columns = np.array(rows, np.int64).reshape(-1, len(PIECES)).T
            batch = pa.RecordBatch.from_arrays([pa.array(keys, kind_arrow), *[pa.array(np.ascontiguousarray(c)) for c in columns]], names=[kind.name, *PIECES.names])
            keys.clear()
            rows.clear()
            return batch

        packer = Packer(limits, out)
        kind_arrow = None
        for batch in it:
            kind_arrow = batch.schema.field("k").type
            losses = batch.column("l").to_pylist()
            for k, n, ids in zip(batch.column("k").to_pylist(), losses, token_ids(batch.column("t"), coder, end), strict=True):
                packer.add(k, ids, n)
                if len(rows) >= 10_000:
                    yield flush()
        packer.close()
        if rows:
            yield flush()

    return map_arrow(chosen, run, T.StructType([kind, *PIECES.fields]))


def op4_packing(spark, sf_dir: str) -> DataFrame:
    """Pack all documents by the word tokenizer into sequences of 4096."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
