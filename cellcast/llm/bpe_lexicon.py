"""Byte-level BPE with a compiled lexicon of frequent words.

The corpus' most frequent words (up to ``LEXICON``, a bound on what is broadcast) become a minimal acyclic transducer:
states with equal futures are shared, and the outputs along a path add up to the word's row in an id table. Its arrays are
one file in the shared folder, which Spark hands to every worker and workers memory-map. Words that the lexicon
lacks are merged exactly by rank, so the ids never depend on which words it holds.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellcast.llm.common import shared_dir, staged, texts

LEXICON = 50_000
SPACE = "\t-\r \x85\xa0  -     　"
# A chunk never cuts a word of the tokenizer: a word holds at most one leading blank and no other white space.
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Fixed value: the words of this kind of tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, added tokens and exact merging by rank, from a tokenizer file."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols, model = byte_symbols(), spec["model"]
        self.bytes = {i: bytes(symbols[c] for c in t) for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = model["vocab"]
        made = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if made != sorted(made) or len(made) + 256 != len(ids):
            raise ValueError("merge order and ids differ: this vocabulary cannot be merged by id")
        ranks = {b: i for i, b in self.bytes.items()}
        self._bpe = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        self.split = regex.compile(WORDS).findall
        self.table = [self.bytes.get(i, b"") for i in range(max([*self.bytes, *self.added.values()]) + 1)]
        for content, i in self.added.items():
            self.table[i] = content.encode()
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")").split

    def merge(self, word: bytes) -> list[int]:
        return self._bpe.encode_single_piece(word)

    def decode(self, ids: list[int]) -> str:
        table = self.table
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


def compile_lexicon(words: Iterable[tuple[bytes, list[int]]]) -> np.ndarray:
    """A flat int32 array: header, sorted arcs (state * 256 + byte), targets, outputs, final states, id offsets, ids.

    Words come sorted and distinct. States are registered by their arcs as soon as their words end (equal futures
    become one state); the output of an arc is the number of words before those behind it.
    """
    pairs = list(words)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # final, ((byte, target), ...)
    count: list[int] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
            count.append(node[0] + sum(count[t] for _, t in node[1]))
        return register[key]

    path: list[list] = [[False, []]]
    before = b""
    for word, _ in pairs:
        keep = 0
        while keep < min(len(word), len(before)) and word[keep] == before[keep]:
            keep += 1
        for i in range(len(before), keep, -1):
            path[i - 1][1].append((before[i - 1], freeze(path.pop())))
        path += [[False, []] for _ in range(len(word) - keep)]
        path[-1][0] = True
        before = word
    for i in range(len(before), 0, -1):
        path[i - 1][1].append((before[i - 1], freeze(path.pop())))
    root = freeze(path[0])
    arcs = []
    for s, (final, out) in enumerate(states):
        passed = int(final)
        for byte, target in out:
            arcs.append((s * 256 + byte, target, passed))
            passed += count[target]
    arcs.sort()
    key, target, add = np.array(arcs, dtype=np.int32).reshape(-1, 3).T
    offsets = np.cumsum([0] + [len(ids) for _, ids in pairs])
    flat = [i for _, ids in pairs for i in ids]
    head = [root, len(arcs), len(states), len(pairs)]
    return np.concatenate([head, key, target, add, [f for f, _ in states], offsets, flat]).astype("<i4")


class Lexicon:
    """Looks up many words at once: one vectorised step for each byte."""

    def __init__(self, flat: np.ndarray):
        self.root, a, s, w = (int(x) for x in flat[:4])
        self.key, self.target, self.add = flat[4:4 + a], flat[4 + a:4 + 2 * a], flat[4 + 2 * a:4 + 3 * a]
        at = 4 + 3 * a
        self.final, self.offsets, self.ids = flat[at:at + s], flat[at + s:at + s + w + 1], flat[at + s + w + 1:]

    def rows(self, words: list[bytes]) -> np.ndarray:
        """The row of each word, -1 for those not held."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        data = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(lengths) - lengths
        state, row, live = np.full(n, self.root), np.zeros(n, np.int64), np.arange(n)
        step = 0
        while len(live) and len(self.key):
            live = live[lengths[live] > step]
            want = state[live] * 256 + data[start[live] + step]
            at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[at] == want
            state[live[~hit]] = -1
            live, at = live[hit], at[hit]
            state[live] = self.target[at]
            row[live] += self.add[at]
            step += 1
        held = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        return np.where(held, row, -1)

    def encoded(self, row: int) -> bytes:
        return self.ids[self.offsets[row]:self.offsets[row + 1]].tobytes()


class Encoder:
    """Ids of texts as little-endian uint32 bytes; chunks seen lately are kept in a bounded dictionary."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon, most: int = 300_000):
        self.vocabulary, self.lexicon, self.most = vocabulary, lexicon, most
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _learn(self, new: set[str]) -> None:
        split = self.vocabulary.split
        cut = {c: split(c) for c in new}
        wanted = list({w for ws in cut.values() for w in ws}.difference(self.words))
        raw = [w.encode() for w in wanted]
        for word, b, row in zip(wanted, raw, self.lexicon.rows(raw).tolist()):
            if row >= 0:
                self.words[word] = self.lexicon.encoded(row)
            else:
                self.words[word] = array("I", self.vocabulary.merge(b)).tobytes()
        own = self.words
        self.chunks.update((c, b"".join([own[w] for w in ws])) for c, ws in cut.items())

    def learn(self, texts: list[str]) -> list[list[str]]:
        """The chunks of some texts, all of them known afterwards: their new words are looked up together."""
        found = [CHUNK.findall(t) for t in texts]
        need = set().union(*found)
        new = need.difference(self.chunks)
        if len(self.chunks) + len(new) > self.most:
            self.chunks.clear()
            self.words.clear()
            new = need
        self._learn(new)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Added tokens' strings cut a text; what lies between is ordinary text."""
        added, cut = self.vocabulary.added, self.vocabulary.cut
        parts = [cut(t) if any(a in t for a in added) else [t] for t in texts]
        found = iter(self.learn([p for ps in parts for p in ps if p not in added]))
        get = self.chunks.__getitem__
        return [b"".join(array("I", [added[p]]).tobytes() if p in added else b"".join(map(get, next(found))) for p in ps) for ps in parts]


def in_slices(column: pa.Array, chars: int = 1_000_000) -> Iterator[list[str]]:
    """The texts of a column, about so many characters at a time."""
    out, size = [], 0
    for text in column:
        out.append(text.as_py())
        size += len(out[-1])
        if size >= chars:
            yield out
            out, size = [], 0
    if out:
        yield out


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``word, n`` over the whole corpus, added up in each task (and flushed when its dictionary is full) before it moves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Vocabulary(tokenizer).split

        def flush(chunks: Counter) -> pa.RecordBatch:
            words: Counter = Counter()
            for c, n in chunks.items():
                for w in split(c):
                    words[w] += n
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        chunks: Counter = Counter()
        for batch in batches:
            for text in batch.column(1):
                chunks.update(CHUNK.findall(text.as_py()))
                if len(chunks) > 1_000_000:
                    yield flush(chunks)
                    chunks.clear()
        yield flush(chunks)

    return texts(docs).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _publish(spark: SparkSession, flat: np.ndarray) -> str:
    """Writes the lexicon to the shared folder and has Spark copy it to every executor; returns its file name."""
    name = f"lexicon-{uuid.uuid4().hex}.i4"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(flat.tobytes()))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def frequent_words(docs: DataFrame, tokenizer: str, size: int) -> list[str]:
    """The most frequent words that the corpus has at least twice, whole classes of frequency only, at most ``size``.

    Classes are 32 to an octave, so there are at most 2,048; only their sizes and the chosen words come to the driver.
    """
    counts = staged(word_counts(docs, tokenizer).filter("n > 1").select("word", F.floor(32 * F.log2("n")).alias("class")), "words")
    sizes = counts.groupBy("class").count().orderBy(F.desc("class")).collect()
    total, least = 0, None
    for row in sizes:
        total += row["count"]
        if total > size:
            break
        least = row["class"]
    return [] if least is None else [r["word"] for r in counts.filter(F.col("class") >= least).select("word").collect()]


def build_lexicon(docs: DataFrame, tokenizer: str, size: int = LEXICON) -> str:
    """Compiles the frequent words and publishes them. Ids never depend on which words these are."""
    vocabulary = Vocabulary(tokenizer)
    words = sorted(w.encode() for w in frequent_words(docs, tokenizer, size) if len(w) <= 200)
    return _publish(docs.sparkSession, compile_lexicon((w, vocabulary.merge(w)) for w in words))


def encoded(docs: DataFrame, tokenizer: str, size: int = LEXICON, keep: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]`` for every row; a null text is empty."""
    name = build_lexicon(docs, tokenizer, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(tokenizer)
        encoder = Encoder(vocabulary, Lexicon(np.memmap(SparkFiles.get(name), dtype="<i4", mode="r")))
        for batch in batches:
            cols: list[list] = [[] for _ in range(3 + 2 * keep)]
            for ids in (i for texts_ in in_slices(batch.column(1)) for i in encoder.encode(texts_)):
                back = vocabulary.decode(np.frombuffer(ids, "<u4").tolist())
                sums = [hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest()]
                for col, value in zip(cols, [len(ids) // 4, *sums, ids, back]):
                    col.append(value)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: 4 + 2 * keep]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=names)

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * keep
    return texts(docs).mapInArrow(run, schema)
