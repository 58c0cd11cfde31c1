"""Bigram language model in a log-frequency Bloom filter.

Texts become blocks of word numbers once. Words and bigrams are hashed; the top bits of a hash name a segment. Blocks
send each segment their distinct hashes with counts as one packed row, the segment adds them up over the corpus and, for
words, answers every block; so nothing travels word by word. Bigram counts are quantised (level 1 + floor(log2 count)) and
level j of a bigram is stored as the entries 1 to j of a Bloom filter. The filter grows with the corpus, by segments, and never
travels: a segment is made where its counts meet, and answers every block there. Probing goes up the levels until an entry is
missing, and the level reached gives the smoothed probability
``weight * 2^(level-1) / count(previous word) + (1 - weight) * (count + 1) / (N + V + 1)``.

A segment with many entries gets the ``LEAST_BITS`` bits an entry that it needs; no bigram and no level is left out at any size.
All words are counted exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from cellcast.llm.common import word_hashes, mix, staged, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLOCK_CHARS = 8_000_000
BITS_A_TOKEN = 8
LEAST_BITS = 5
PROBES = 4
WEIGHT = 0.5
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
KEY_BITS = 40


def lower_words(text: str) -> list[str]:
    """A-Z in lower case, then words; bytes.lower() touches ASCII only."""
    return WORD.findall(text.lower() if text.isascii() else text.encode().lower().decode())


def bigram_hash(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(after))


def _zip(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unzip(b: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=kind)


BLOCK = "block bigint, doc_ids array<bigint>, held array<boolean>, lengths array<int>, words binary, vocabulary binary, n_words bigint, n_train bigint, n_vocabulary bigint"


def token_blocks(docs: DataFrame, chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of whole documents, about ``chars`` characters each: word numbers and the hashes they stand for."""
    def packed(part: int, i: int, ids: list, held: list, hashes: list[np.ndarray]) -> pa.RecordBatch:
        lengths = np.array([len(h) for h in hashes], dtype=np.int32)
        values, at, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        place = np.empty(len(values), dtype=np.int32)  # frequent words get small numbers
        place[np.argsort(-counts, kind="stable")] = np.arange(len(values), dtype=np.int32)
        by_place = np.empty_like(values)
        by_place[place] = values
        train = int(lengths[~np.array(held, dtype=bool)].sum())
        row = [(part << 32) + i, ids, held, lengths.tolist(), _zip(place[at].astype("<i4")), by_place.astype("<u8").tobytes(), int(lengths.sum()), train, len(values)]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, size, part = 0, 0, 0
        ids, held, hashes = [], [], []
        for batch in batches:
            for doc, out, number, text in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3)), batch.column(1)):
                text, part = text.as_py(), number
                ids.append(doc)
                held.append(out)
                hashes.append(np.append(word_hashes(lower_words(text)), END))
                size += len(text) + 1
                if size >= chars:
                    yield packed(part, i, ids, held, hashes)
                    ids, held, hashes, i, size = [], [], [], i + 1, 0
        if ids:
            yield packed(part, i, ids, held, hashes)

    out = F.crc32(F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit(""))) % 7 == 2
    return texts(docs, out.alias("held"), F.spark_partition_id().cast("bigint").alias("part")).mapInArrow(run, BLOCK)


def _train(row, lengths: np.ndarray) -> np.ndarray:
    return np.repeat(~np.array(row["held"], dtype=bool), lengths)


def _by_segment(hashes: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted hashes by their top ``bits``."""
    top = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, top[1:] != top[:-1]]) if len(top) else np.zeros(0, int)
    for a, b in zip(cut, np.r_[cut[1:], len(top)]):
        yield int(top[a]), slice(int(a), int(b))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def word_counts(blocks: DataFrame, bits: int) -> DataFrame:
    """``block, segment, counts, n, v``: answers to each block; the rows with block -1 hold a segment's totals."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words = _unzip(row["words"], "<i4")
            lengths = np.array(row["lengths"])
            counts = np.bincount(words[_train(row, lengths)], minlength=row["n_vocabulary"]).astype("<u4")
            values = np.frombuffer(row["vocabulary"], "<u8")
            order = np.argsort(values)
            values, counts = values[order], counts[order]
            parts = list(_by_segment(values, bits))
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array([s for s, _ in parts], pa.int64()), "block": pa.array([row["block"]] * len(parts), pa.int64()),
                "hashes": pa.array([values[c].tobytes() for _, c in parts], pa.binary()),
                "own": pa.array([_zip(counts[c]) for _, c in parts], pa.binary())})

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(h) // 8 for h in frame.hashes]
        values, at = np.unique(np.frombuffer(b"".join(frame.hashes), "<u8"), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([_unzip(c, "<u4") for c in frame.own])).astype("<i8")
        answers = [_zip(part) for part in np.split(total[at], np.cumsum(sizes)[:-1])]
        return pd.DataFrame({
            "block": [*frame.block, -1], "segment": key[0], "counts": [*answers, b""],
            "n": [*[0] * len(frame), int(total.sum())], "v": [*[0] * len(frame), int((total > 0).sum())]})

    asked = blocks.mapInArrow(ask, "segment bigint, block bigint, hashes binary, own binary")
    return asked.groupBy("segment").applyInPandas(add, "block bigint, segment bigint, counts binary, n bigint, v bigint")


def _doc_bigrams(hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each word; a document starts after START."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[np.cumsum(lengths) - lengths] = START
    return before, bigram_hash(before, hashes)


def _low(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits - KEY_BITS)) & np.uint64((1 << KEY_BITS) - 1)


def _spots(keys: np.ndarray, level: int, seg_bits: int) -> Iterator[np.ndarray]:
    """Bit places of entry ``level`` of each key within its segment."""
    with np.errstate(over="ignore"):
        h = mix(keys * np.uint64(0xDA942042E4DD58B5) + np.uint64(level))
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield (a + np.uint64(i) * b) % np.uint64(seg_bits)


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count), exact for whole numbers."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def filter_segment(keys: np.ndarray, counts: np.ndarray, seg_bits: int) -> bytes:
    """The bits of one segment."""
    high = levels(counts)
    bits = np.zeros(seg_bits, dtype=bool)
    for level in range(1, int(high.max(initial=0)) + 1):
        for spot in _spots(keys[high >= level], level, seg_bits):
            bits[spot] = True
    return np.packbits(bits, bitorder="little").tobytes()


def bigram_levels(blocks: DataFrame, bits: int, seg_bits: int) -> DataFrame:
    """``block, segment, levels``: each segment's answers about a block's distinct bigrams in ascending order, from the Bloom filter
    of the segment's training bigrams."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            lengths = np.array(row["lengths"])
            hashes = np.frombuffer(row["vocabulary"], "<u8")[_unzip(row["words"], "<i4")]
            values, at = np.unique(_doc_bigrams(hashes, lengths)[1], return_inverse=True)
            counts = np.bincount(at[_train(row, lengths)], minlength=len(values)).astype("<u4")
            # 40 bits below the segment's own are enough to tell bigrams apart, and 5 bytes travel instead of 8.
            low = _low(values, bits).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
            parts = list(_by_segment(values, bits))
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array([s for s, _ in parts], pa.int64()), "block": pa.array([row["block"]] * len(parts), pa.int64()),
                "keys": pa.array([low[c].tobytes() for _, c in parts], pa.binary()),
                "counts": pa.array([_zip(counts[c]) for _, c in parts], pa.binary())})

    def answer(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        raw = np.frombuffer(b"".join(frame["keys"]), np.uint8).reshape(-1, 5)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :5] = raw
        values, at = np.unique(wide.view("<u8").ravel(), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([_unzip(c, "<u4") for c in frame.counts]))
        level = segment_levels(values, total, seg_bits)
        cuts = np.cumsum([len(k) // 5 for k in frame["keys"]])[:-1]
        return pd.DataFrame({"block": frame.block, "segment": key[0], "levels": [_zip(part) for part in np.split(level[at], cuts)]})

    asked = blocks.mapInArrow(ask, "segment bigint, block bigint, keys binary, counts binary")
    return asked.groupBy("segment").applyInPandas(answer, "block bigint, segment bigint, levels binary")


def segment_levels(keys: np.ndarray, counts: np.ndarray, seg_bits: int) -> np.ndarray:
    """The level of each key of a segment, by a filter of those with a count: of ``seg_bits`` bits, or as many as its entries need."""
    known, counts = keys[counts > 0], counts[counts > 0]
    seg_bits = max(seg_bits, -(-int(levels(counts).sum()) * LEAST_BITS // 8) * 8)
    made = np.frombuffer(filter_segment(known, counts, seg_bits), np.uint8)
    return _reached(made, keys, np.zeros(len(keys), dtype=np.uint64), seg_bits).astype(np.uint8)


def probe(filter_: np.ndarray, hashes: np.ndarray, bits: int, seg_bits: int) -> np.ndarray:
    """The level of each bigram: how many entries in a row are there."""
    return _reached(filter_, _low(hashes, bits), (hashes >> np.uint64(64 - bits)) * np.uint64(seg_bits), seg_bits)


def _reached(filter_: np.ndarray, keys: np.ndarray, base: np.ndarray, seg_bits: int) -> np.ndarray:
    out = np.zeros(len(keys), dtype=np.int64)
    live, level = np.arange(len(keys)), 0
    while len(live) and level < 63:
        level += 1
        there = np.ones(len(live), dtype=np.uint8)
        for spot in _spots(keys[live], level, seg_bits):
            at = base[live] + spot
            there &= filter_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)
        live = live[(there & 1).astype(bool)]
        out[live] = level
    return out


def power_of_two(n: int) -> int:
    return max(0, int(n - 1).bit_length())


def score(docs: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    A null or empty text is its end alone. A null ``doc_id`` trains. Repeated rows count as often as they come.
    Without training text every count is 0 and N + V + 1 is 1, so all scores are 0.
    """
    blocks = staged(token_blocks(docs), "blocks")
    sums = blocks.agg(F.sum("n_vocabulary"), F.sum("n_train")).first()
    vocabulary, train = (int(x or 0) for x in sums)
    # Segments follow the data, so that one of them always holds about as many entries.
    word_bits = max(6, power_of_two(vocabulary // 200_000 + 1))
    pair_bits = max(6, power_of_two(train // 400_000 + 1))
    answers = staged(word_counts(blocks, word_bits), "counts")
    totals = answers.filter("block = -1").agg(F.sum("n"), F.sum("v")).first()
    n, v = (int(x or 0) for x in totals)
    seg_bits = max(64, (BITS_A_TOKEN * max(train, 1) >> pair_bits) // 8 * 8)
    reached = bigram_levels(blocks, pair_bits, seg_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            values = np.frombuffer(row["vocabulary"], "<u8")
            by_hash = np.concatenate([_unzip(a["counts"], "<i8") for a in sorted(row["answers"], key=lambda a: a["segment"])])
            known = np.empty(len(values), dtype=np.int64)
            known[np.argsort(values)] = by_hash
            lengths = np.array(row["lengths"], dtype=np.int64)
            words = _unzip(row["words"], "<i4")
            c, hashes = known[words], values[words]
            first = np.cumsum(lengths) - lengths
            before, pairs = _doc_bigrams(hashes, lengths)
            context = np.empty_like(c)
            context[1:] = c[:-1]
            # Each training document has one end and so one start.
            end = int(known[np.flatnonzero(values == END)[0]])
            context[first] = end
            by_pair = np.concatenate([_unzip(a["levels"], "u1") for a in sorted(row["reached"], key=lambda a: a["segment"])])
            level = by_pair[np.unique(pairs, return_inverse=True)[1]].astype(np.int64)
            alone = (c + 1) / (n + (v + 1))
            seen = np.where(level > 0, np.exp2(level - 1.0), 0.0)
            share = np.minimum(seen, context) / np.maximum(context, 1)
            p = np.where(context > 0, weight * share + (1 - weight) * alone, alone)
            total = lambda x: np.add.reduceat(x, first)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()),
                "n_tokens": pa.array(lengths), "n_known": pa.array(total((c > 0).astype(np.int64))),
                "train_tokens": pa.array(np.full(len(lengths), n, dtype=np.int64)),
                "base_score": pa.array(total(np.log10(alone))), "score": pa.array(total(np.log10(p)))})

    gathered = answers.filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("segment", "counts")).alias("answers"))
    pair_levels = reached.groupBy("block").agg(F.collect_list(F.struct("segment", "levels")).alias("reached"))
    return blocks.join(gathered, "block").join(pair_levels, "block").mapInArrow(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
