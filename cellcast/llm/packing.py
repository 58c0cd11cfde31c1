"""Best-fit packing of tokenised documents after Martello-Toth dominance reduction.

The plan is made from the counts of each length (at most ``capacity`` numbers), never from the documents:
a plan entry says "so many sequences hold these lengths". Documents then look up their place by their rank
among the documents of their length, which Spark computes in salted windows.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from cellcast.llm.bpe_lexicon import byte_symbols
from cellcast.llm.common import staged, texts

CAPACITY = 2048
END_ID = 0
SALTS = 1024
CHUNK = re.compile(r"[^ \t\n\r\x0b\x0c]+")
# Characters that normalisation leaves as they are (but for case), so that a chunk can be split here.
PLAIN = re.compile("[!-~¡-ɏ]+")
WORD_END = b"\xff"
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class ChunkEncoder(dict):
    """Ids of white-space separated chunks, as little-endian uint32 bytes; chunks seen lately stay in this dictionary.

    The tokenizer drops white space and no piece spans it, so a text's ids are those of its chunks in a row. Pieces are
    merged by rank: a piece is its bytes and ``WORD_END``, a byte that no text has, for the end-of-word suffix.
    """

    def __init__(self, path: str, most: int = 200_000):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        self.split = regex.compile(PIECE).findall
        self.most = most
        self.pieces: dict[str, bytes] = {}
        ranks = ranks_with_ends(path)
        self.merge = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def __missing__(self, chunk: str) -> bytes:
        if PLAIN.fullmatch(chunk) and "<|" not in chunk:
            own = self.pieces
            for p in (parts := self.split(chunk.lower())):
                if p not in own:
                    own[p] = array("I", self.merge(p.encode() + WORD_END)).tobytes()
            out = b"".join([own[p] for p in parts])
        else:
            out = array("I", self.tok.encode(chunk, add_special_tokens=False).ids).tobytes()
        self[chunk] = out
        return out

    def encode(self, text: str) -> bytes:
        if len(self) > self.most:
            self.clear()
        if len(self.pieces) > self.most:
            self.pieces.clear()
        return b"".join(map(self.__getitem__, CHUNK.findall(text)))


@lru_cache(maxsize=1)
def encoder_of(path: str) -> ChunkEncoder:
    """One encoder for all tasks of a worker: the vocabulary is read once, and memory does not grow with the number of tasks."""
    return ChunkEncoder(path)


def ranks_with_ends(path: str) -> dict[bytes, int]:
    """Token bytes to ids of a vocabulary with end-of-word suffixes; single bytes, then their ends, then merges by rank."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    symbols, suffix = byte_symbols(), model["end_of_word_suffix"]
    ranks = {}
    for token, i in model["vocab"].items():
        ends = token.endswith(suffix) and len(token) > len(suffix)
        raw = bytes(symbols[c] for c in (token[: -len(suffix)] if ends else token))
        if WORD_END not in raw:
            ranks[raw + WORD_END * ends] = i
    ranks[WORD_END] = model["vocab"][next(c for c, b in symbols.items() if b == WORD_END[0])]  # never met alone
    return ranks


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, ids]``: each document's ids and an end id, cut only beyond capacity.

    A null or empty text is the end id alone. Repeated rows stay separate documents.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        end = np.array([END_ID], dtype="<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
        for batch in batches:
            cols: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = ids[4 * start:4 * (start + capacity)]
                    for col, value in zip(cols, (doc, piece, start, len(part) // 4, zlib.crc32(part), part)):
                        col.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    return texts(docs).mapInArrow(run, schema)


class Plan:
    """Groups of equal sequences: ``(how many, [(length, times), ...])``."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {k: int(n) for k, n in counts.items() if n}
        self.groups: list[tuple[int, tuple[tuple[int, int], ...]]] = []
        self.fixed = 0
        self._reduce()
        self._best_fit()

    def _fix(self, many: int, lengths: list[int]) -> None:
        items: dict[int, int] = {}
        for x in lengths:
            items[x] = items.get(x, 0) + 1
        for x, t in items.items():
            self.left[x] -= many * t
            if not self.left[x]:
                del self.left[x]
                self.order.pop(bisect.bisect_left(self.order, x))
        self.groups.append((many, tuple(sorted(items.items(), reverse=True))))
        self.fixed += many

    def _smallest(self, j: int, n: int) -> list[int]:
        out: list[int] = []
        for x in self.order:
            out += [x] * min(n - len(out), self.left[x] - (x == j))
            if len(out) == n:
                break
        return out

    def _largest(self, most: int, used: list[int]) -> int:
        i = bisect.bisect_right(self.order, most) - 1
        while i >= 0 and self.left[self.order[i]] <= used.count(self.order[i]):
            i -= 1
        return self.order[i] if i >= 0 else 0

    def _dominating(self, j: int) -> list[int] | None:
        """The companions of j in a set that dominates every other feasible set with j, if one is provable."""
        rest = self.capacity - j
        k = self._largest(rest, [j])
        if not k:
            return []
        small = self._smallest(j, 3)
        if k == rest or sum(small[:2]) > rest or len(small) < 2:
            return [k]
        if len(small) < 3 or sum(small) > rest:  # two companions at most
            b = self._largest(rest - k, [j, k])
            if b and b >= self._largest(rest // 2, [j]):
                return [k, b]
            pairs = [x + self._largest(min(x, rest - x), [j, x]) for x in self.order
                     if x < rest and self.left[x] > (x == j) and self._largest(min(x, rest - x), [j, x])]
            if not pairs or max(pairs) <= k:
                return [k]
        return None

    def _reduce(self) -> None:
        """Martello and Toth's reduction: fix dominating sets, largest first, until none is left."""
        self.order = sorted(self.left)
        again = True
        while again:
            again = False
            for j in sorted(self.left, reverse=True):
                while j in self.left and (more := self._dominating(j)) is not None:
                    chosen = [j, *more]
                    # A set stays dominating while all its lengths last: others only get fewer.
                    many = min(self.left[x] // chosen.count(x) for x in chosen)
                    self._fix(many, chosen)
                    again = True

    def _best_fit(self) -> None:
        """Best fit, longest first, over counts: sequences with equal content are one entry."""
        spare: dict[int, list[list]] = {}
        rooms: list[int] = []

        def put(room: int, many: int, items: tuple) -> None:
            if room not in spare:
                spare[room] = []
                bisect.insort(rooms, room)
            spare[room].append([many, items])

        for x in sorted(self.left, reverse=True):
            n = self.left[x]
            while n:
                i = bisect.bisect_left(rooms, x)
                room, many, items = (rooms[i], *spare[rooms[i]][-1]) if i < len(rooms) else (self.capacity, n, ())
                times = min(room // x, n)
                take = min(many, n // times)
                if i < len(rooms):
                    if take == many:
                        spare[room].pop()
                        if not spare[room]:
                            del spare[room]
                            rooms.pop(i)
                    else:
                        spare[room][-1][0] -= take
                put(room - times * x, take, (*items, (x, times)))
                n -= take * times
        self.groups += [(many, items) for held in spare.values() for many, items in held]

    @property
    def sequences(self) -> int:
        return sum(many for many, _ in self.groups)

    def segments(self) -> dict[int, np.ndarray]:
        """By length: rows of first rank, first sequence, times in a sequence, offset; ranks ascending."""
        out: dict[int, list[tuple[int, int, int, int]]] = {}
        rank: dict[int, int] = {}
        first = 0
        for many, items in self.groups:
            offset = 0
            for x, times in items:
                out.setdefault(x, []).append((rank.get(x, 0), first, times, offset))
                rank[x] = rank.get(x, 0) + many * times
                offset += x * times
            first += many
        return {x: np.array(rows, dtype=np.int64) for x, rows in out.items()}


def ranked_by_length(pieces: DataFrame, salts: int = SALTS) -> DataFrame:
    """``rank`` from 0 among the pieces of a length. A length may hold most rows: it is ranked in salted parts."""
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    part = W.partitionBy("length", "_salt")
    below = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    offsets = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"))
    own = F.row_number().over(part.orderBy("doc_id", "piece", "ids_crc32")) - 1
    return (salted.withColumn("_own", own).join(offsets, ["length", "_salt"])
            .withColumn("rank", (F.col("_own") + F.col("_before")).cast("bigint")).drop("_salt", "_own", "_before"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``. ``pieces`` (staged: it is read twice) has lengths of 1 to capacity.

    The only rows that reach the driver are the counts by length. The plan that goes to the workers has at most
    a few entries for each length, whatever the number of documents. No pieces: no rows.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = Plan(counts, capacity).segments()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("rank")
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(at).to_numpy(zero_copy_only=False)
            seq, off = np.zeros_like(rank), np.zeros_like(rank)
            for x in np.unique(length):
                sel = np.flatnonzero(length == x)
                rows = where[int(x)]
                row = rows[np.searchsorted(rows[:, 0], rank[sel], side="right") - 1]
                step = rank[sel] - row[:, 0]
                seq[sel] = row[:, 1] + step // row[:, 2]
                off[sel] = row[:, 3] + step % row[:, 2] * x
            kept = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(seq), pa.array(off)],
                names=[batch.schema.names[i] for i in kept] + ["sequence_id", "offset"])

    ranked = ranked_by_length(pieces)
    fields = ", ".join(f"`{n}` {t}" for n, t in ranked.dtypes if n != "rank")
    return ranked.mapInArrow(run, f"{fields}, sequence_id bigint, `offset` bigint")


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """All documents as pieces with their place: tokenised once, staged, planned, placed."""
    pieces = staged(token_pieces(docs, tokenizer, capacity, keep_ids), "pieces")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * keep_ids
    return pack(pieces, capacity).select(*cols)
