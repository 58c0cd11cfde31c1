"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document is its lower-cased words. Each of ``SKETCHES`` random orders picks the two smallest occurrence-labelled
5-word windows and keeps them in text order; documents that agree in one such pair are candidates. A candidate pair is
linked if its word alignment needs at most 0.2 edits for each word of the longer document (similarity 0.8 or more).

Equal texts are one node, named by digest. In a bucket every member meets a leader. Members linked to it have its class, and an
unlike member cannot be alike to one of them if it is further from the leader than the two distances allow (edits obey the
triangle inequality; what words one text lacks bounds them from below). So after a round only unlike members and the few linked
ones that this bound does not settle go on to the next leader. What is left after ``ROUNDS`` leaders meets in blocks of bounded
size, where counts of words rule out most pairs and only links between classes are returned. So every pair that shares a
bucket is verified, ruled out by a bound, or in one class already.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cellcast.llm.common import word_hashes, mix, staged, texts, unused
from cellcast.llm.components import components, contracted

WINDOW = 5
SKETCHES = 16
SIMILARITY = 0.8
ROUNDS = 2
BLOCK = 256  # members of a bucket that meet in one task
SLOTS, FINE_SLOTS = 256, 4096  # of word counts that rule out pairs
NO_ID = (1 << 63) - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Odd multipliers; windows are well mixed before, so that a product is order enough.
_SEEDS = mix(np.arange(1, 1025, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def windows(hashes: np.ndarray, k: int = WINDOW) -> np.ndarray:
    """Occurrence-labelled k-word windows as 64-bit values; a shorter text is one window."""
    n = len(hashes)
    if not n:
        return hashes
    k = min(k, n)
    with np.errstate(over="ignore"):
        out = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            out = mix(out + hashes[j:n - k + 1 + j] + np.uint64(j + 1))
        order = np.argsort(out, kind="stable")
        low = out[order]
        first = np.r_[True, low[1:] != low[:-1]]
        if not first.all():
            at = np.arange(len(low))
            label = at - np.maximum.accumulate(np.where(first, at, 0))
            out[order] = mix(low + label.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out


def order_keys(hashes: np.ndarray, sketches: int = SKETCHES) -> list[int]:
    """One key for each random order: the two smallest windows, in the order of the text."""
    own = windows(hashes)
    if not len(own):
        return []
    n, step = len(own), max(1, 4_000_000 // len(own))
    keys = []
    for t in range(0, sketches, step):  # a few orders at a time for a long text
        seeds = _SEEDS[t:min(t + step, sketches), None]
        h = own * seeds
        rows = np.arange(len(h))
        one = h.argmin(axis=1)
        a = h[rows, one]
        h[rows, one] = np.uint64(0xFFFFFFFFFFFFFFFF)
        two = h.argmin(axis=1) if n > 1 else one
        b = h[rows, two] if n > 1 else a
        first, second = np.where(one <= two, a, b), np.where(one <= two, b, a)
        keys.append(mix(mix(first ^ seeds[:, 0]) + second))
    return np.concatenate(keys).view(np.int64).tolist()


def _banded(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance of a (the longer) and b if it is at most ``most`` (< len(a)), on bit vectors of 2·most+1 diagonals."""
    n, m = len(a), len(b)
    width = 2 * most + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    vp, vn, dist = full ^ ((1 << most) - 1), 0, most
    held: dict[int, tuple[int, int]] = {}
    a, b = a.tolist(), b.tolist()
    for row in range(min(most, n)):  # rows above the first window's last one; the bit of row r at column i is r - i + most
        at, bits = held.get(a[row], (0, 0))
        held[a[row]] = (0, bits | (1 << (row + most)))
    turn, worst, mark = n - most, most + m - (n - most), top
    for i in range(m):
        row = i + most
        if row < n:
            at, bits = held.get(a[row], (i, 0))
            held[a[row]] = (i, (bits >> (i - at)) | top)
        at, bits = held.get(b[i], (i, 0))
        x = bits >> (i - at)
        d0 = ((((x & vp) + vp) ^ vp) | x | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        if i < turn:
            dist += not d0 & top
        else:
            mark >>= 1
            dist += bool(hp & mark)
            dist -= bool(hn & mark)
        if dist > worst:
            return None
        low = d0 >> 1
        vp = (hn | ~(low | hp)) & full
        vn = low & hp
    return dist if dist <= most else None


def edits_within(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edits between two word sequences, or None if over ``most``. Equal ends go first, narrow bands before wide ones."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return None
    m = len(b)
    off = np.flatnonzero(a[:m] != b[:m])
    head = int(off[0]) if len(off) else m
    a, b = a[head:], b[head:]
    m = len(b)
    off = np.flatnonzero(a[len(a) - m:][::-1] != b[::-1])
    tail = int(off[0]) if len(off) else m
    a, b = a[:len(a) - tail], b[:m - tail]
    if not len(b) or len(a) <= most:
        return len(a) if not len(b) or len(a) == 1 else _within_short(a, b, most)
    band = max(len(a) - len(b), 16)
    while band < most and band < len(a):
        if (got := _banded(a, b, band)) is not None:
            return got
        if band == max(len(a) - len(b), 16):  # unlike pairs end here: words that the other lacks need an edit each
            left = sum((Counter(a.tolist()) - Counter(b.tolist())).values())
            if left > most:
                return None
        band *= 4
    return _banded(a, b, most)


def _within_short(a: np.ndarray, b: np.ndarray, most: int) -> int:
    got = _banded(a, b, len(a) - 1)
    return len(a) if got is None else got


def alike(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    longest = max(len(a), len(b))
    return edits_within(a, b, _most(longest, similarity)) is not None


def least_edits(a: np.ndarray, b: np.ndarray) -> int:
    """A number of edits that turning one word sequence into the other needs at least: the words that either lacks."""
    apart = np.bincount(a % FINE_SLOTS, minlength=FINE_SLOTS) - np.bincount(b % FINE_SLOTS, minlength=FINE_SLOTS)
    return int(max(apart[apart > 0].sum(), -apart[apart < 0].sum()))


def sketches(docs: DataFrame, count: int = SKETCHES) -> DataFrame:
    """``doc, digest, keys``: the text's 128-bit digest and its order keys (none without words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [order_keys(word_hashes(words_of(text.as_py())), count) for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64()))], names=["doc", "digest", "keys"])

    return _digested(docs).mapInArrow(run, "doc bigint, digest binary, keys array<bigint>")


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _digested(docs: DataFrame) -> DataFrame:
    return texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), _digest(F.col("text")).alias("digest"), "text")


def _sequences(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, words`` (32-bit word hashes) of the given nodes ``(node, doc, digest)`` only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(word_hashes(words_of(text.as_py())) >> np.uint64(32)).astype("<u4").tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["node", "words"])

    both = nodes.join(_digested(docs), ["doc", "digest"]).select("node", "text")
    return both.mapInArrow(run, "node bigint, words binary").dropDuplicates(["node"])


def _words(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype="<u4") for x in column]


def _judged(pairs: DataFrame, sequences: DataFrame, similarity: float) -> DataFrame:
    """``node, leader, linked, apart`` for each pair: the edits between linked ones, else a bound from below.

    A leader may be in most pairs: that join splits by its pairs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, apart = [], []
            for a, b in zip(_words(batch.column(2)), _words(batch.column(3))):
                most = _most(max(len(a), len(b)), similarity)
                got = low = least_edits(a, b)
                if low <= most:
                    got = edits_within(a, b, most)
                linked.append(got is not None and got <= most)
                apart.append(got if linked[-1] else max(low, most + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_()), pa.array(apart, pa.int64())], names=["node", "leader", "linked", "apart"])

    own = sequences.select("node", F.col("words").alias("a"))
    other = sequences.select(F.col("node").alias("leader"), F.col("words").alias("b"))
    both = pairs.join(own, "node").join(other, "leader").select("node", "leader", "a", "b")
    return both.mapInArrow(run, "node bigint, leader bigint, linked boolean, apart bigint")


def _most(words: int, similarity: float) -> int:
    return int(round((1 - similarity) * words, 6))


def _left(met: DataFrame, similarity: float) -> DataFrame:
    """``key, node, size`` of the members that may be alike to a member of another class, of all that have met their leader.

    Let B be linked to the leader A and C not. Then B and C need at least apart(C) - apart(B) edits, and alike texts at most
    ``1 - similarity`` for each word of the longer.
    """
    share = 1 - similarity
    unlike = F.when(~F.col("linked"), F.col("apart"))
    edge = met.groupBy("key").agg(
        F.min(unlike - share * F.col("size")).alias("own"), F.min(unlike).alias("nearest"),
        F.max(F.when(F.col("linked"), F.col("size"))).alias("longest"))
    edge = edge.filter("nearest IS NOT NULL").select("key", F.least("own", F.col("nearest") - share * F.col("longest")).alias("edge"))
    return met.join(edge, "key").filter(~F.col("linked") | (F.col("apart") >= F.col("edge") - 1e-6)).select("key", "node", "size")


def _counts(words: list[np.ndarray], slots: int) -> np.ndarray:
    """A row of word counts for each text, as narrow as its longest one allows."""
    kind = np.uint16 if max(map(len, words)) < 1 << 16 else np.int64
    return np.array([np.bincount(w % slots, minlength=slots).astype(kind) for w in words])


def _meeting(similarity: float):
    """Links between the classes of blocks: a spanning set for each key."""
    def run(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy()
        order = np.argsort(keys, kind="stable")
        nodes, classes, sides = (table.column(c).to_numpy() for c in ("node", "class", "side"))
        words = _words(table.column("words").combine_chunks())
        out: list[tuple[int, int]] = []
        for own in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
            size = np.array([len(words[i]) for i in own])
            coarse, fine = (_counts([words[i] for i in own], slots) for slots in (SLOTS, FINE_SLOTS))
            label, side = classes[own].copy(), sides[own]
            for i in range(len(own)):
                # Of two blocks, members of the first meet those of the second; of one, each meets those behind it.
                there = np.flatnonzero((label != label[i]) & ((side == 1) & (side[i] == 0) | (side == 2) & (np.arange(len(own)) > i)))
                for counts in (coarse, fine):  # most pairs are ruled out by the first
                    longer = np.maximum(size[there], size[i])
                    common = np.minimum(counts[there], counts[i]).sum(axis=1, dtype=np.int64)
                    there = there[longer - common <= np.round((1 - similarity) * longer, 6)]
                for j in there.tolist():
                    if label[i] != label[j] and alike(words[own[i]], words[own[j]], similarity):
                        out.append((int(nodes[own[j]]), int(nodes[own[i]])))
                        label[label == label[j]] = label[i]
        return pa.table({"node": pa.array([a for a, _ in out], pa.int64()), "leader": pa.array([b for _, b in out], pa.int64())})

    return run


def _all_met(left: DataFrame, stars: DataFrame, sequences: DataFrame, similarity: float) -> DataFrame:
    """Links between members of a key that ``stars`` leave apart: all blocks of a key meet in pairs.

    The smallest neighbour serves as a class: nodes of one class are linked. Classes that further links would join only
    meet in vain. Keys of one block share tasks. Blocks are dealt by hash, so that a task has two blocks' members at most.
    """
    lowest = stars.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("class"))
    named = left.join(lowest, "node", "left").select("key", "node", F.coalesce("class", "node").alias("class"))
    several = named.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("n"))
    several = several.filter("low < high").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = staged(named.join(several, "key").join(sequences, "node"), "members")
    tasks = max(1, rows.count() // BLOCK)
    one = rows.filter("blocks = 1").select(
        F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("task"), F.lit(-1).alias("a"), F.lit(-1).alias("b"), "key", "node", "class", F.lit(2).alias("side"), "words")
    many = rows.filter("blocks > 1").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1)
    many = many.select(F.col("key").alias("task"), F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
                       "key", "node", "class", side.alias("side"), "words")
    return one.unionByName(many).groupBy("task", "a", "b").applyInArrow(_meeting(similarity), "node bigint, leader bigint")


def near_links(docs: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links ``(node, leader)``, verified or leading along verified ones, between the distinct texts ``nodes (node, doc, digest, keys)``; ``doc`` has the text.

    The classes of the links are those of all alike pairs that share a bucket.
    """
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = staged(keyed.join(shared, "key"), "members")
    own = nodes.join(members.select("node").distinct(), "node")
    sequences = staged(_sequences(docs, own.select("node", "doc", "digest")), "sequences")
    sizes = sequences.select("node", (F.octet_length("words") / 4).cast("bigint").alias("size"))
    left, links = members.join(sizes, "node").select("key", "node", "size"), []
    for _ in range(ROUNDS):
        leaders = left.groupBy("key").agg(F.min("node").alias("leader"))
        met = left.join(leaders, "key").filter("node <> leader")
        pairs = met.select("node", "leader").distinct()
        judged = staged(_judged(pairs, sequences, similarity), "judged")
        links.append(judged.filter("linked").select("node", "leader"))
        left = staged(_left(met.join(judged, ["node", "leader"]), similarity), "members")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, links)
    stars = contracted(reduce(DataFrame.unionByName, links), "node", "leader")
    found = stars.select(F.col("u").alias("node"), F.col("v").alias("leader"))
    return found.unionByName(staged(_all_met(left, stars, sequences, similarity), "links"))


def classified(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc, digest, class_doc, kept`` for every row of ``docs``: its id (null: ``NO_ID``), its text's digest, its class."""
    rows = staged(sketches(docs), "sketches")
    nodes = rows.groupBy("digest").agg(F.min("doc").alias("doc"), F.first("keys").alias("keys"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    classes = staged(components(near_links(docs, nodes, similarity), "node", "leader"), "classes")
    named = nodes.join(classes, "node", "left").select("doc", "digest", F.coalesce("component", "node").alias("class"))
    best = named.groupBy("class").agg(F.min(F.struct("doc", "digest")).alias("best"))
    named = named.join(best, "class").select("digest", "best")
    kept = (F.col("doc") == F.col("best.doc")) & (F.col("digest") == F.col("best.digest"))
    return rows.select("doc", "digest").join(named, "digest").select("doc", "digest", F.col("best.doc").alias("class_doc"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, kept`` for every row; the class id is the smallest ``doc_id`` of the class, the row with it is kept.

    Null and empty texts equal each other; texts without words match exact copies only. Texts are told apart by digest, so
    different texts under one id, or without an id, are documents of their own; null ids come last, and a class
    without any other has a null class id. Of two texts with the class's id the one with the smaller digest is kept. Rows
    equal in id and text are one document.
    """
    id_ = lambda c, name: F.when(F.col(c) != NO_ID, F.col(c)).alias(name)
    return classified(docs, similarity).select(id_("doc", "doc_id"), id_("class_doc", "class_id"), "kept")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, all columns. Of rows equal in id and text any one stays."""
    id_, digest, doc, own = unused(docs, "_kept_id", "_kept_digest", "_own_id", "_own_digest")
    rows = staged(classified(docs, similarity).groupBy("doc", "digest").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n")), "classes")
    keys = lambda df: df.select(F.col("doc").alias(id_), F.col("digest").alias(digest))
    same = (F.col(doc) == F.col(id_)) & (F.col(own) == F.col(digest))
    keyed = docs.withColumns({doc: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), own: _digest(F.coalesce(F.col("text"), F.lit("")))})
    repeated = rows.filter("kept AND n > 1")
    if repeated.isEmpty():
        return keyed.join(keys(rows.filter("not kept")), same, "left_anti").select(*docs.columns)
    once = keyed.join(keys(rows.filter("not kept OR n > 1")), same, "left_anti")
    more = keyed.join(keys(repeated), same, "left_semi").dropDuplicates([doc, own])
    return once.unionByName(more).select(*docs.columns)
