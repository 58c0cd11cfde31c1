"""Collocations: phrases whose parts stand together more often than apart, by counting quotient filters.

Only words with at least ``least`` occurrences in their language get an id: any other word ends a run, as no phrase with it
can be frequent. A phrase of k words is packed as the id of its first k - 1 words, itself such a phrase, and the id of its last
word; the packed number is permuted invertibly and counted in quotient filters, one for each block of text and range of
permuted keys. The filters of a range merge into its counts and every block learns which of its phrases are frequent,
with their ids. So a phrase of k + 1 words is counted only where both of its phrases of k words are frequent: nothing that
can reach ``least`` is left out, and no dictionary is broadcast.

A key is in a block's filter once, with its count, so a hot phrase is one entry a block. Blocks have a bounded number of words,
ranges a bounded number of entries.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from cellcast.llm import quotient
from cellcast.llm.common import discard, shuffle_parts, staged, word_hashes

LONGEST = 5
LEAST = 100
TOP = 2000
SHARE = 100  # percent of a phrase's occurrences in one longer phrase at which it goes
BLOCK = 1 << 20  # words
ENTRIES = 1 << 20  # of a range
WORDS = 1 << 18  # likewise, of words themselves
NO_LANG = "und"
_BREAK = b"\n"
# Lower case, piece ends as line ends, tabs as spaces.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def _split(text: str) -> Iterator[bytes]:
    """Words, and a break after each piece."""
    return filter(None, (text.encode().translate(_PLAIN) + _BREAK).replace(_BREAK, b" \n ").split(b" "))


def _joined(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(_BREAK.join(words))


def _apart(blob: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split(_BREAK)


def _blocks(docs: DataFrame) -> DataFrame:
    """``block, lang, tokens, distinct, words, counts, places``: up to about ``BLOCK`` words of one language.

    ``words`` are the block's distinct ones, the commonest first; ``places`` holds the words in the order of the text, as
    positions in ``words`` plus 1; 0 ends a piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        open_: dict[str, tuple[defaultdict, list]] = {}

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal made
            made += 1
            known, places = open_.pop(lang)
            at = np.concatenate(places)
            counts = np.bincount(at, minlength=len(known))[1:]
            order = np.argsort(-counts, kind="stable")
            rank = np.zeros(len(known), dtype=np.int64)
            rank[order + 1] = np.arange(1, len(known))
            words = list(known)[1:]
            return pa.RecordBatch.from_arrays([
                pa.array([first + made]), pa.array([lang]), pa.array([int(counts.sum())]), pa.array([len(words)], pa.int64()),
                pa.array([_joined([words[i] for i in order.tolist()])], pa.binary()), pa.array([quotient.pack(counts[order])], pa.binary()),
                pa.array([quotient.pack(rank[at])], pa.binary())],
                names=["block", "lang", "tokens", "distinct", "words", "counts", "places"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang not in open_:
                    known: defaultdict = defaultdict()
                    known.default_factory = known.__len__
                    known[_BREAK]
                    open_[lang] = known, []
                known, places = open_[lang]
                places.append(np.fromiter(map(known.__getitem__, _split(text.as_py())), dtype=np.int64))
                if sum(map(len, places)) >= BLOCK or len(places) >= 1 << 14:
                    places[:] = [np.concatenate(places)]
                    if len(places[0]) >= BLOCK:
                        yield closed(lang)
            if sum(len(p) for _, places in open_.values() for p in places) >= 4 * BLOCK:  # many languages, little of each
                for lang in list(open_):
                    yield closed(lang)
        for lang in list(open_):
            yield closed(lang)

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)), F.coalesce(F.col("text"), F.lit("")))
    return rows.mapInArrow(run, "block bigint, lang string, tokens bigint, distinct bigint, words binary, counts binary, places binary")


def _word_runs(blocks: DataFrame, shard: int) -> DataFrame:
    """``shard, block, lang, words, counts, at`` of every block: its words by hash, and where they are in the block's list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, words, counts in zip(*(batch.column(i) for i in range(4))):
                words, counts = _apart(words.as_py()), quotient.unpack(counts.as_py())
                of = (word_hashes(words) >> np.uint64(64 - shard)).astype(np.int64) if shard else np.zeros(len(words), dtype=np.int64)
                order = np.argsort(of, kind="stable")
                for part, at in zip(np.unique(of).tolist(), np.split(order, np.flatnonzero(np.diff(of[order])) + 1)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part], pa.int64()), pa.array([block.as_py()]), pa.array([lang.as_py()]),
                        pa.array([_joined([words[i] for i in at.tolist()])], pa.binary()), pa.array([quotient.pack(counts[at])], pa.binary()),
                        pa.array([quotient.pack(at)], pa.binary())], names=["shard", "block", "lang", "words", "counts", "at"])

    return blocks.select("block", "lang", "words", "counts").mapInArrow(
        run, "shard bigint, block bigint, lang string, words binary, counts binary, at binary")


def _counted_words(runs: DataFrame, least: int) -> DataFrame:
    """Each range merged: a row with its frequent words, the commonest first, and a reply to each block, 0 where rare."""
    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(table.column("lang").to_pylist(), (_apart(x.as_py()) for x in table.column("words"))))
        total: dict[str, dict[bytes, int]] = defaultdict(dict)
        for (lang, words), counts in zip(rows, table.column("counts")):
            own = total[lang]
            for word, n in zip(words, quotient.unpack(counts.as_py()).tolist()):
                own[word] = own.get(word, 0) + n
        often = sorted((-n, lang, word) for lang, own in total.items() for word, n in own.items() if n >= least)
        place: dict[str, dict[bytes, int]] = defaultdict(dict)
        for i, (_, lang, word) in enumerate(often, start=1):
            place[lang][word] = i
        replies = [quotient.pack(np.fromiter((place[lang].get(w, 0) for w in words), dtype=np.int64, count=len(words))) for lang, words in rows]
        none = [None] * len(rows)
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()] * (len(rows) + 1), pa.int64()),
            "block": pa.array([None, *table.column("block").to_pylist()], pa.int64()), "reply": pa.array([None, *replies], pa.binary()),
            "at": pa.array([None, *table.column("at").to_pylist()], pa.binary()),
            "lang": pa.array([[lang for _, lang, _ in often], *none], pa.list_(pa.string())),
            "word": pa.array([[word.decode() for *_, word in often], *none], pa.list_(pa.string())),
            "n": pa.array([[-n for n, *_ in often], *none], pa.list_(pa.int64()))})

    return runs.groupBy("shard").applyInArrow(
        run, "shard bigint, block bigint, reply binary, at binary, lang array<string>, word array<string>, n array<bigint>")


def _state(block: int, words: np.ndarray, grams: np.ndarray, k: int) -> pa.RecordBatch | None:
    """A block's words and the phrases of k words that start at each, without what no longer phrase can need."""
    both = (grams[:-1] >= 0) & (grams[1:] >= 0)
    todo = int(both.sum())
    if not todo:
        return None
    need = np.zeros(len(words) + 1, dtype=np.int64)  # words of phrases of k + 1 words
    at = np.flatnonzero(both)
    np.add.at(need, at, 1)
    np.add.at(need, at + k + 1, -1)
    need = np.cumsum(need)[:-1] > 0
    keep = need | np.r_[False, need[:-1]]  # one break behind each run
    words, grams = np.where(need, words, -1)[keep], np.where(need, grams, -1)[keep]
    grams = None if k == 1 else quotient.pack(grams + 1)  # else they are the words
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([todo]), pa.array([quotient.pack(words + 1)], pa.binary()), pa.array([grams], pa.binary())],
        names=["block", "todo", "words", "grams"])


def _read(words: pa.Scalar, grams: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    words = quotient.unpack(words.as_py()) - 1
    return words, quotient.unpack(grams.as_py()) - 1 if grams.is_valid else words


_STATE = "block bigint, todo bigint, words binary, grams binary"


def _with_ids(blocks: DataFrame, replies: DataFrame, ranges: int) -> DataFrame:
    """The blocks as word ids: what is rare is a break."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, places, shards, own, at in zip(*(batch.column(i) for i in range(5))):
                places = quotient.unpack(places.as_py())
                known = np.full(int(places.max(initial=0)) + 1, -1, dtype=np.int64)
                for part, reply, where in zip(shards.as_py(), own.as_py(), at.as_py()):
                    reply = quotient.unpack(reply)
                    known[quotient.unpack(where) + 1] = np.where(reply > 0, (reply - 1) * ranges + part, -1)
                words = np.r_[known[places], -1]
                if (out := _state(block.as_py(), words, words, 1)) is not None:
                    yield out

    own = replies.groupBy("block").agg(F.collect_list(F.struct("shard", "reply", "at")).alias("own"))
    both = blocks.select("block", "places").join(own, "block").select(
        "block", "places", F.col("own.shard").alias("shards"), F.col("own.reply").alias("own"), F.col("own.at").alias("at"))
    return both.mapInArrow(run, _STATE)


def _keys(words: np.ndarray, grams: np.ndarray, k: int, word_bits: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where phrases of k words start that can be frequent, and their permuted keys."""
    at = np.flatnonzero((grams[:-1] >= 0) & (grams[1:] >= 0))
    packed = (grams[at].astype(np.uint64) << np.uint64(word_bits)) | words[at + k - 1].astype(np.uint64)
    return at, quotient.permute(packed, bits)


def _filters(state: DataFrame, k: int, word_bits: int, bits: int, shard: int) -> DataFrame:
    """``shard, block, filter`` of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, grams in zip(*(batch.column(i) for i in range(3))):
                words, grams = _read(words, grams)
                keys, counts = quotient.counted(_keys(words, grams, k, word_bits, bits)[1])
                for part, where in quotient.parts(keys, bits, shard):
                    own = quotient.within(keys[where], bits, shard)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int64()), pa.array([block.as_py()]), pa.array([quotient.encode(own, counts[where], bits - shard)], pa.binary())],
                        names=["shard", "block", "filter"])

    return state.select("block", "words", "grams").mapInArrow(run, "shard bigint, block bigint, filter binary")


def _counts(filters: DataFrame, word_bits: int, bits: int, shard: int, least: int) -> DataFrame:
    """Each range merged: a row with its frequent phrases, and for each block a reply with their places, 0 where rare."""
    def run(table: pa.Table) -> pa.Table:
        part, blocks = table.column("shard")[0].as_py(), table.column("block").to_pylist()
        runs = [quotient.decode(x.as_py()) for x in table.column("filter")]
        keys, counts = quotient.merged(runs)
        often = counts >= least
        keys, counts = keys[often], counts[often]
        place = np.zeros(1 + len(keys), dtype=np.int64)
        place[1:] = np.arange(1, len(keys) + 1)
        replies = []
        for own, _ in runs:
            at = np.searchsorted(keys, own)
            hit = keys[np.minimum(at, len(keys) - 1)] == own if len(keys) else np.zeros(len(own), dtype=bool)
            replies.append(quotient.pack(np.where(hit, at + 1, 0)))
        packed = quotient.restore(keys | np.uint64(part << (bits - shard)), bits)
        lists = [(packed >> np.uint64(word_bits)).astype(np.int64), (packed & np.uint64((1 << word_bits) - 1)).astype(np.int64), counts]
        none = [None] * len(blocks)
        return pa.table({
            "shard": pa.array([part] * (len(blocks) + 1), pa.int64()), "block": pa.array([None, *blocks], pa.int64()),
            "reply": pa.array([None, *replies], pa.binary()),
            **{name: pa.array([x.tolist(), *none], pa.list_(pa.int64())) for name, x in zip(("prefix", "last", "n"), lists)}})

    return filters.groupBy("shard").applyInArrow(
        run, "shard bigint, block bigint, reply binary, prefix array<bigint>, last array<bigint>, n array<bigint>")


def _longer(state: DataFrame, replies: DataFrame, k: int, word_bits: int, bits: int, stride: int) -> DataFrame:
    """The blocks with the ids of their frequent phrases of k words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, grams, shards, own in zip(*(batch.column(i) for i in range(5))):
                words, grams = _read(words, grams)
                at, keys = _keys(words, grams, k, word_bits, bits)
                _, back = np.unique(keys, return_inverse=True)
                got = sorted(zip(shards.as_py(), own.as_py()))
                ids = np.concatenate([np.where((r := quotient.unpack(blob)) > 0, s * stride + r - 1, -1) for s, blob in got])
                grams = np.full(len(words), -1, dtype=np.int64)
                grams[at] = ids[back]
                if (out := _state(block.as_py(), words, grams, k)) is not None:
                    yield out

    own = replies.groupBy("block").agg(F.collect_list(F.struct("shard", "reply")).alias("own"))
    both = state.join(own, "block").select("block", "words", "grams", F.col("own.shard").alias("shards"), F.col("own.reply").alias("own"))
    return both.mapInArrow(run, _STATE)


def _named(grams: DataFrame, shorter: DataFrame, words: DataFrame, k: int) -> DataFrame:
    """Phrases of k words with text, and the counts of all their beginnings and endings: the parts of every cut."""
    first = shorter.select(F.col("id").alias("prefix"), "lang", "total", "words", "phrase", "starts")
    last = words.select(F.col("id").alias("last"), F.col("phrase").alias("word"))
    tail = shorter.select(F.col("words").alias("tail"), "ends")
    out = grams.join(first, "prefix").join(last, "last")
    out = out.withColumn("words", F.concat("words", F.array("last"))).withColumn("tail", F.slice("words", 2, k - 1)).join(tail, "tail")
    return out.select(
        "id", "lang", "total", "words", F.concat_ws(" ", "phrase", "word").alias("phrase"),
        F.concat("starts", F.array("n")).alias("starts"), F.concat(F.array("n"), "ends").alias("ends"))


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> list[DataFrame]:
    """For each length from 1: ``id, lang, total, words, phrase, starts, ends`` of every phrase found ``least`` times.

    ``total`` counts the words of the language, ``starts`` the phrase's beginnings of 1, 2, ... words, ``ends`` its endings from
    the whole phrase down to the last word. Null texts are empty, null languages are ``und``.
    """
    blocks = staged(_blocks(docs), "blocks")
    totals = blocks.groupBy("lang").agg(F.sum("tokens").alias("total"))
    shard = quotient.shard_bits(blocks.agg(F.sum("distinct")).first()[0] or 0, WORDS)
    merged = staged(_counted_words(_word_runs(blocks.filter("distinct > 0"), shard), least), "words")
    # The commonest words have the smallest ids.
    frequent = merged.filter("block IS NULL").select("shard", F.posexplode(F.arrays_zip("lang", "word", "n")).alias("at", "own"))
    frequent = frequent.select((F.col("at") * (1 << shard) + F.col("shard")).alias("id"), "own.lang", "own.word", "own.n")
    own = F.array("n")
    levels = [staged(frequent.join(totals, "lang").select(
        "id", "lang", "total", F.array("id").alias("words"), F.col("word").alias("phrase"), own.alias("starts"), own.alias("ends")), "phrases")]
    state = staged(_with_ids(blocks, merged.filter("block IS NOT NULL"), 1 << shard), "state")
    discard(blocks, merged)
    word_bits = gram_bits = int(levels[0].agg(F.max("id")).first()[0] or 0).bit_length()
    for k in range(2, longest + 1):
        bits = max(1, gram_bits + word_bits)
        if bits > 64:
            raise ValueError(f"phrases of {k} words need {bits} bits; raise `least`")
        shard = min(bits, quotient.shard_bits(state.agg(F.sum("todo")).first()[0] or 0, ENTRIES))
        merged = staged(_counts(_filters(state, k, word_bits, bits, shard), word_bits, bits, shard, least), "counts")
        stride = max(1, merged.agg(F.max(F.size("n"))).first()[0] or 0)
        grams = merged.filter("block IS NULL").select("shard", F.posexplode(F.arrays_zip("prefix", "last", "n")).alias("at", "gram"))
        grams = grams.select((F.col("shard") * stride + F.col("at")).alias("id"), "gram.prefix", "gram.last", "gram.n")
        levels.append(staged(_named(grams, levels[-1], levels[0], k), "phrases"))
        if k < longest:
            replies = merged.filter("block IS NOT NULL").select("shard", "block", "reply")
            longer = staged(_longer(state, replies, k, word_bits, bits, stride), "state")
            discard(state)
            state = longer
            gram_bits = ((1 << shard) * stride).bit_length()
        discard(merged)
    discard(state)
    return levels


def _decimal(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def scored(levels: list[DataFrame]) -> DataFrame:
    """``lang, words, phrase, a, l, r, n, score`` of every candidate: phrases of two words and more, by their lowest cut."""
    out = None
    for k, level in list(enumerate(levels, start=1))[1:]:
        cuts = []
        for j in range(1, k):
            l, r = F.col("starts")[j - 1], F.col("ends")[j]
            top = _decimal(F.lit(1000)) * _decimal(F.col("ends")[0]) * _decimal("total")
            cuts.append(F.struct(F.call_function("div", top, _decimal(l) * _decimal(r)).alias("score"), F.lit(j).alias("cut"), l.alias("l"), r.alias("r")))
        low = level.select("lang", "words", "phrase", F.col("ends")[0].alias("a"), F.col("total").alias("n"), F.array_min(F.array(*cuts)).alias("low"))
        low = low.select("lang", "words", "phrase", "a", "low.l", "low.r", "n", "low.score")
        out = low if out is None else out.unionByName(low)
    return out


def without_parts(candidates: DataFrame, longest: int = LONGEST, share: int = SHARE) -> DataFrame:
    """The candidates that no longer candidate holds in ``share`` percent of their occurrences."""
    size = F.size("words")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("words", i, n))))
    held = candidates.filter(size > 2).select(F.explode(inner).alias("words"), F.col("a").alias("most"))
    held = held.groupBy("words").agg(F.max("most").alias("most"))
    out = candidates.join(held, "words", "left")
    return out.filter(F.col("most").isNull() | (_decimal("most") * 100 < _decimal("a") * share)).drop("most")


def best(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` with ``rank``: by score, occurrences, then phrase. Salted parts are cut to ``top`` first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("words"), F.lit(shuffle_parts(candidates.sparkSession)))
    some = candidates.withColumn("_salt", salt)
    some = some.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_at") <= top)
    out = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    return out.drop("_salt", "_at")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases of 2 to 5 words.

    Null texts are empty, null languages are ``und``; repeated rows count as often as they are there; ties go by phrase. A table
    without frequent phrases gives no rows. Only ``lang`` and ``text`` are read, other columns may have any name.
    """
    kept = best(without_parts(scored(phrases(docs, least=least)), share=share), top)
    return kept.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
