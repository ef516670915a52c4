"""Byte-level BPE encoding and decoding with padded numpy matrices.

Texts are cut by the tokenizer's pattern; every distinct piece is encoded once. Pieces go into buckets of like length, a
bucket being one matrix of token ids padded on the right. In each round every row merges its leftmost pair of minimum
rank: the ranks of neighbouring pairs come from an open-addressing hash table of (left, right), a row-wise argmin picks
the pair, and deleting one cell a row compacts the matrix; rows without a mergeable pair leave. Only the two pairs beside
a merge are looked up again. A matrix has at most CELLS cells. Pieces beyond LONG bytes (a run of letters without any space,
digit or point) are merged one at a time with a heap, which gives the same ids without work that grows with the square of
the length.

Decoding gathers the tokens' bytes; encode and decode are exact inverses for any valid text.

Defined results: null is the empty text with no ids; repeated rows get equal results; an empty table gives no rows; extra
columns pass through, one that is named like the result is replaced by it.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from groundplan.llm import textscan
from groundplan.llm.frames import append_column, struct_of
from groundplan.llm.pieces import UnitCache, gather
from groundplan.llm.textscan import MULT, U, mix

LONG = 16384
CELLS = 1 << 22
NONE = np.int32(2**31 - 1)
#: White space of Unicode beyond ASCII in UTF-8; where it occurs, units of text are not independent.
_WIDE_SPACE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_SPACE_CLASS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class PairTable:
    """Ranks of token pairs, in an open-addressing table that whole arrays are looked up in."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        keys = self._key(left, right)
        bits = max(4, int(4 * len(keys)).bit_length())
        self.mask = U((1 << bits) - 1)
        self.keys = np.full(1 << bits, U(2**64 - 1), U)
        self.rank = np.full(1 << bits, NONE, np.int32)
        at = mix(keys) & self.mask
        todo = np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = self.keys[at[todo]] == U(2**64 - 1)
            slots, first = np.unique(at[todo[free]], return_index=True)
            put = todo[free][first]
            self.keys[slots], self.rank[slots] = keys[put], rank[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            at[todo] = (at[todo] + U(1)) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(U) << U(32)) | right.astype(U)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = self._key(left, right)
        out = np.full(len(keys), NONE, np.int32)
        at = mix(keys) & self.mask
        todo = np.arange(len(keys))
        for _ in range(self.probes):
            found = self.keys[at]
            hit = found == keys
            out[todo[hit]] = self.rank[at[hit]]
            on = ~hit & (found != U(2**64 - 1))
            if not on.any():
                break
            todo, keys, at = todo[on], keys[on], (at[on] + U(1)) & self.mask
        return out


class ByteBPE:
    """An encoder and decoder by the ranks of a .tiktoken file; without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(_explicit_spaces(pattern))
        size = max(ranks.values(), default=-1) + 1
        table = [b""] * size
        for token, rank in ranks.items():
            table[rank] = token
        self.token_bytes = table
        self.sizes = np.array([len(t) for t in table], np.int64)
        self.store = np.frombuffer(b"".join(table), np.uint8)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        split = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.pairs = PairTable(*np.array(split, np.int64).reshape(-1, 3).T.astype(np.int32))
        self.cache = UnitCache(self._encode_units)

    @staticmethod
    def from_file(path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as f:
            return ByteBPE({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    # One piece is what the pattern matches; one unit is white space and the word behind it.

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif len(p) > LONG:
                out[i] = self._merge_long(p)
            elif p:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(i)
            else:
                out[i] = np.empty(0, np.int32)
        for rows in buckets.values():
            most = max(1, min(8192, CELLS // max(len(pieces[i]) for i in rows)))
            for lo in range(0, len(rows), most):
                self._merge_bucket(pieces, rows[lo : lo + most], out)
        return out

    def _merge_bucket(self, pieces: list[bytes], rows: list[int], out: list) -> None:
        sizes = np.array([len(pieces[i]) for i in rows])
        width = int(sizes.max())
        ids = np.full((len(rows), width), -1, np.int32)
        inside = np.arange(width) < sizes[:, None]
        ids[inside] = self.bytes[np.frombuffer(b"".join(pieces[i] for i in rows), np.uint8)]
        rank = np.full((len(rows), width), NONE, np.int32)  # of each cell with its right neighbour
        both = inside[:, 1:]
        rank[:, :-1][both] = self.pairs(ids[:, :-1][both], ids[:, 1:][both])
        row = np.array(rows)
        while len(row):
            at = rank.argmin(1)
            every = np.arange(len(row))
            best = rank[every, at]
            stuck = best == NONE
            if stuck.any():
                for i in np.flatnonzero(stuck):
                    cells = ids[i]
                    out[row[i]] = cells[cells >= 0].copy()
                on = ~stuck
                row, ids, rank, at, best = row[on], ids[on], rank[on], at[on], best[on]
                if not len(row):
                    return
                every = np.arange(len(row))
            width = ids.shape[1]
            ids[every, at] = best
            keep = np.ones(ids.shape, bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(len(row), width - 1)
            rank = rank[keep].reshape(len(row), width - 1)
            for here in (at, at - 1):
                ok = here >= 0
                r, c = every[ok], here[ok]
                new = np.full(len(r), NONE, np.int32)
                has = c + 1 < width - 1
                right = np.where(has, ids[r, np.minimum(c + 1, width - 2)], -1)
                has &= right >= 0
                new[has] = self.pairs(ids[r[has], c[has]], right[has])
                rank[r, c] = new

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece, by a heap of (rank, position) over a linked list."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        parts = [bytes([b]) for b in piece]
        heap = [(r, i) for i in range(n - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or self.ranks.get(parts[i] + parts[j]) != r:
                continue
            ids[i], ids[j] = r, -1
            parts[i] += parts[j]
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (x := self.ranks.get(parts[a] + parts[after[a]])) is not None:
                    heapq.heappush(heap, (x, a))
        return np.array([x for x in ids if x >= 0], np.int32)

    def _encode_units(self, units: list[bytes]) -> list[np.ndarray]:
        """The ids of units; the distinct pieces of all of them are encoded together."""
        found = [[m.encode() for m in self.pattern.findall(u.decode())] for u in units]
        distinct = list(dict.fromkeys(p for f in found for p in f))
        ids = dict(zip(distinct, self.encode_pieces(distinct), strict=True))
        return [ids[f[0]] if len(f) == 1 else np.concatenate([ids[p] for p in f]) if f else np.empty(0, np.int32) for f in found]

    def encode(self, col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each slice of a string column: all ids one after the other, and the texts' offsets into them."""
        for s in textscan.slices(col):
            word_starts, word_ends = textscan.spans(~textscan.SPACE[s.data], s.offs)
            starts, ends = _units(s, word_starts, word_ends)
            if _WIDE_SPACE.search(s.data):
                starts, ends = self._careful(s, starts, ends)
            flat, sizes = self.cache.lookup(s.data, starts, ends, textscan.span_hashes(s.data, starts, ends))
            yield flat, np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, s.offs)]

    def _careful(self, s: textscan.Slice, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units for texts with white space beyond ASCII: there, each match of the pattern is a unit."""
        out = []
        for d in range(s.hi - s.lo):
            lo, hi = int(s.offs[d]), int(s.offs[d + 1])
            text = s.data[lo:hi].tobytes()
            if _WIDE_SPACE.search(text):
                sizes = [len(m.encode()) for m in self.pattern.findall(text.decode())]
                top = lo + np.cumsum(np.array(sizes, np.int64))
                out.append((top - sizes, top))
            else:
                a, b = np.searchsorted(starts, (lo, hi))
                out.append((starts[a:b], ends[a:b]))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def decode(self, flat: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids one after the other, and the texts' offsets into them."""
        sizes = self.sizes[flat]
        data = gather(self.store, self.begins[flat], sizes)
        return data, np.concatenate([[0], np.cumsum(sizes)])[offs]


def _units(s: textscan.Slice, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """White space and the word behind it; white space at the end of a text is a unit of its own."""
    tops = np.unique(np.concatenate([ends, s.offs[1:]]))
    tops = tops[tops > 0]
    return np.concatenate([[0], tops[:-1]]) if len(tops) else tops, tops


def _explicit_spaces(pattern: str) -> str:
    """The pattern with white space spelled out, as libraries differ on \\s."""
    inside = pattern.replace(r"[^\s", rf"[^{_SPACE_CLASS}")
    return inside.replace(r"\s", f"[{_SPACE_CLASS}]").replace(r"\S", f"[^{_SPACE_CLASS}]")


_coders: dict[tuple[str, str], ByteBPE] = {}


def coder(path: str, pattern: str) -> ByteBPE:
    """The coder of a file, kept by each Python worker."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = ByteBPE.from_file(path, pattern)
    return _coders[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """docs with the ids of each text as array<int>."""

    def work(batch: pa.RecordBatch) -> pa.Array:
        bpe, parts = coder(path, pattern), []
        for flat, offs in bpe.encode(batch.column(text)):
            parts.append(pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(flat, pa.int32())))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return append_column(docs, T.StructField(into, T.ArrayType(T.IntegerType())), work)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """docs with the text of each array of ids as binary (null: empty); ids may cut a character in two."""

    def work(batch: pa.RecordBatch) -> pa.Array:
        bpe, col = coder(path, pattern), batch.column(ids)
        lists = [np.array(x or [], np.int64) for x in col.to_pylist()]
        data, offs = bpe.decode(np.concatenate(lists) if lists else np.empty(0, np.int64), np.cumsum([0, *map(len, lists)]))
        raw = data.tobytes()
        return pa.array([raw[a:b] for a, b in zip(offs[:-1], offs[1:], strict=True)], pa.binary())

    return append_column(docs, T.StructField(into, T.BinaryType()), work)


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", into: str = "digests") -> DataFrame:
    """docs with n_tokens and the SHA-256 of the ids (little-endian unsigned 32-bit) and of the bytes decoded from them."""
    names = ("n_tokens", "ids_sha256", "decoded_sha256")

    def work(batch: pa.RecordBatch) -> pa.Array:
        bpe = coder(path, pattern)
        count: list[int] = []
        of_ids: list[str] = []
        of_text: list[str] = []
        for flat, offs in bpe.encode(batch.column(text)):
            count += np.diff(offs).tolist()
            ids = memoryview(flat.astype("<u4")).cast("B")
            of_ids += [hashlib.sha256(ids[4 * a : 4 * b]).hexdigest() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]
            data, at = bpe.decode(flat, offs)
            view = memoryview(data)
            of_text += [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return struct_of(names, [pa.array(count, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())])

    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return append_column(docs, T.StructField(into, kind), work)


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Encode every document and decode it again, returned as digests."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", F.col("digests.n_tokens").alias("n_tokens"), F.col("digests.ids_sha256").alias("ids_sha256"), F.col("digests.decoded_sha256").alias("decoded_sha256"))
