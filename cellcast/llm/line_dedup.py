"""Line de-duplication against levelled, sorted runs of line hashes.

Batches of documents come in ascending ``doc_id``. The index is a log-structured set of runs, each a sorted table of
line hashes in the shared folder. A batch merge-anti-joins the runs, adds its new hashes as a run of level 0, and
when a level has ``fanout`` runs they are merged into one run of the next level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellcast.llm.common import staged, texts, unused

BLANK = b" \t\n\x0b\x0c\r"
SHORTEST = 10
BATCHES = 4
FANOUT = 2
NO_ID = (1 << 63) - 1  # a null doc_id comes after all others


def line_key(line: bytes) -> bytes:
    """White space off both ends, A-Z in lower case (bytes.lower() touches ASCII only)."""
    return line.strip(BLANK).lower()


def key_hash(key: bytes, shortest: int = SHORTEST) -> bytes | None:
    """128 bits; None for a key under ``shortest`` code points, which never takes part."""
    if len(key) < shortest or (len(key) < 4 * shortest and len(key.decode()) < shortest):
        return None
    return hashlib.md5(key, usedforsecurity=False).digest()


def line_hashes(docs: DataFrame) -> DataFrame:
    """``doc, h1, h2``: the distinct hashes of each document's lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = {key_hash(line_key(x)) for x in text.as_py().encode().split(b"\n")}
                own.discard(None)
                ids += [doc] * len(own)
                digests += own
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                names=["doc", "h1", "h2"])

    keyed = texts(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")
    return keyed.mapInArrow(run, "doc bigint, h1 bigint, h2 bigint")


class HashRuns:
    """Levels of sorted runs ``(h1, h2, keeper)``; keeper is the smallest document that holds the line."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def all(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def _sorted(self, df: DataFrame, level: int) -> DataFrame:
        return staged(df.repartition("h1", "h2").sortWithinPartitions("h1", "h2"), f"run-{level}")

    def add(self, batch: DataFrame) -> None:
        """Keeps what no run holds. Hashes in the runs belong to earlier, so smaller, documents."""
        fresh = batch.groupBy("h1", "h2").agg(F.min("doc").alias("keeper"))
        held = self.all()
        if held is not None:
            fresh = fresh.join(held.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self._place(fresh, 0)

    def _place(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._sorted(run, level))
        if len(self.levels[level]) >= self.fanout:
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            self._place(merged, level + 1)


def dropped_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``doc, gone``: for each document that loses lines the hashes of these lines, 16 bytes each."""
    lines = staged(line_hashes(docs), "lines")
    ends = lines.filter(F.col("doc") != NO_ID).agg(F.min("doc"), F.max("doc")).first()
    low, high = ends if ends[0] is not None else (0, 0)
    step = (high - low) // batches + 1
    runs, lost = HashRuns(fanout), []
    for i in range(batches):
        own = F.col("doc") >= low + i * step
        batch = lines.filter(own & (F.col("doc") < low + (i + 1) * step) if i < batches - 1 else own)
        runs.add(batch)
        held = runs.all()
        lost.append(batch.join(held, ["h1", "h2"]).filter("keeper < doc").select("doc", "h1", "h2"))
    both = F.struct("h1", "h2")
    return reduce(DataFrame.unionByName, lost).groupBy("doc").agg(F.collect_list(both).alias("gone"))


def _kept_text(text: str, drop: set[bytes]) -> tuple[str, int]:
    """The text without the lines whose hash is in ``drop``, and how many went."""
    lines = text.encode().split(b"\n")
    kept = [x for x in lines if key_hash(line_key(x)) not in drop]
    return b"\n".join(kept).decode(), len(lines) - len(kept)


def _hashes(h1: pa.ListScalar, h2: pa.ListScalar) -> set[bytes]:
    if not h1.is_valid:
        return set()
    return {row.tobytes() for row in np.stack([np.asarray(h1.values), np.asarray(h2.values)], axis=1).astype("<i8")}


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped`` for every row: the text without lines that an earlier document has.

    Null or empty text: one empty line, kept. Keys under ten code points always stay. Rows that repeat a
    ``doc_id`` are one document: they keep what that document keeps. A null ``doc_id`` is the last document.
    """
    gone = dropped_lines(docs, batches, fanout)
    keyed = texts(docs).withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    joined = keyed.join(gone, "doc", "left").select("doc_id", "text", "gone.h1", "gone.h2")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            out: list[list] = [[], [], []]
            for text, h1, h2 in zip(*(batch.column(i) for i in (1, 2, 3))):
                text = text.as_py()
                n, drop = text.count("\n") + 1, _hashes(h1, h2)
                text, lost = _kept_text(text, drop) if drop else (text, 0)
                for col, value in zip(out, (text, n, lost)):
                    col.append(value)
            kinds = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]], names=["doc_id", "text", "n_lines", "n_dropped"])

    return joined.mapInArrow(run, "doc_id bigint, text string, n_lines bigint, n_dropped bigint")


def with_new_text(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """The rows of ``docs``, all columns, with ``text`` (and ``n_chars``, where there is one) replaced. Null stays null."""
    own, doc, gone = unused(docs, "_doc", "_gone_doc", "_gone")
    lost = dropped_lines(docs, batches, fanout).select(F.col("doc").alias(doc), F.col("gone").alias(gone))
    keyed = docs.withColumn(own, F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)))
    joined = keyed.join(lost, F.col(own) == F.col(doc), "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(gone)["h1"].alias(own), F.col(gone)["h2"].alias(doc))
    width = len(docs.columns)
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            new = []
            for text, h1, h2 in zip(*(batch.column(i) for i in (at, width, width + 1))):
                text, drop = text.as_py(), _hashes(h1, h2)
                new.append(_kept_text(text, drop)[0] if drop and text is not None else text)
            out = batch.select(list(range(width)))
            out = out.set_column(at, out.schema.field(at), pa.array(new, out.schema.field(at).type))
            if size is not None:
                counts = pa.array([None if t is None else len(t) for t in new], out.schema.field(size).type)
                out = out.set_column(size, out.schema.field(size), counts)
            yield out

    return joined.mapInArrow(run, docs.schema)
