"""Quality by co-training: a classifier on a text's content and one on its metadata teach each other.

Both are logistic regressions. In each round either view labels the pool documents that it is sure of for the other view.
Held-back labels calibrate each view and weigh the two against each other; then every document is scored by both.
The fit sees at most ``LABELLED`` labelled and ``POOL`` unlabelled documents, chosen by the hash of their ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellcast.llm.common import word_hashes, texts
from cellcast.llm.quality_rules import WORD, text_counts

LABELLED = 20_000
POOL = 20_000
ROUNDS = 3
SURE = 0.95
A_ROUND = 500  # pseudo-labels of each class from each view and round
BUCKETS = 64
KEEP_GOOD = 0.995  # of the held-back good documents stay


def content(text: str) -> np.ndarray:
    """Shares of kinds of characters, repetition, and the hashed words' frequencies."""
    n, chars, symbols, dups, repeats, lines, capitals = text_counts(text)
    words = WORD.findall(text.lower())
    if not n:
        return np.zeros(9 + BUCKETS)
    raw = np.frombuffer(text.encode(), np.uint8)
    digits = ((raw >= 48) & (raw <= 57)).sum()
    marks = np.isin(raw, np.frombuffer(b"!?;:~^=@_\\/", np.uint8)).sum()
    shares = np.sqrt([symbols / chars, dups / max(lines, 1), repeats / n, capitals / chars, digits / chars, marks / chars])
    counts = np.bincount((word_hashes(words) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    return np.concatenate([[1.0, np.log(max(chars / n, 1)), len(set(words)) / n], shares, np.sqrt(counts / n)])


def metadata(text: str, lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Language, source, declared and real size, and the layout of lines."""
    out = np.zeros(6 + 8 + 32)
    lines = text.count("\n") + 1
    size = len(text)
    out[:6] = [1.0, np.log1p(size), np.log1p(lines), np.log1p(size / lines), np.log1p(n_chars if n_chars and n_chars > 0 else 0), n_chars is None]
    at = (word_hashes([f"lang={lang}", f"source={source}"]) % np.array([8, 32], np.uint64)).astype(np.int64)
    out[6 + at[0]] = out[14 + at[1]] = 1.0
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column is the constant."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _with_one(*cols: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(cols[0])), *cols])


@dataclass
class Model:
    views: list[np.ndarray]
    calibration: list[np.ndarray]
    combined: np.ndarray
    threshold: float

    def __call__(self, x: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = [_with_one(v @ w) @ c for v, w, c in zip(x, self.views, self.calibration)]
        return sigmoid(z[0]), sigmoid(z[1]), sigmoid(_with_one(*z) @ self.combined)


def surest(p: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the documents that no round has taught yet, the surest good and bad ones and their labels."""
    at = np.flatnonzero(left)
    order = at[np.argsort(-p[at], kind="stable")]
    good, bad = order[:A_ROUND], order[::-1][:A_ROUND]
    good, bad = good[p[good] >= SURE], bad[p[bad] <= 1 - SURE]
    return np.r_[good, bad], np.r_[np.ones(len(good)), np.zeros(len(bad))]


def co_train(x: list[np.ndarray], y: np.ndarray, held: np.ndarray, pool: list[np.ndarray], rounds: int = ROUNDS) -> Model:
    own_x, own_y = [v[~held] for v in x], [y[~held].astype(float)] * 2
    left = np.ones(len(pool[0]), dtype=bool)
    views = [logistic(a, b) for a, b in zip(own_x, own_y)]
    for _ in range(rounds):
        taught: list[tuple[np.ndarray, np.ndarray]] = []
        for view in (0, 1):
            taught.append(surest(sigmoid(pool[view] @ views[view]), left))
        for view in (0, 1):
            at, labels = taught[1 - view]
            own_x[view] = np.concatenate([own_x[view], pool[view][at]])
            own_y[view] = np.concatenate([own_y[view], labels])
        for at, _ in taught:
            left[at] = False
        views = [logistic(a, b) for a, b in zip(own_x, own_y)]
    out = [v[held] @ w for v, w in zip(x, views)]
    target = y[held].astype(float)
    calibration = [logistic(_with_one(z), target) for z in out]
    z = [_with_one(v) @ c for v, c in zip(out, calibration)]
    combined = logistic(_with_one(*z), target)
    good = sigmoid(_with_one(*z) @ combined)[target == 1]
    return Model(views, calibration, combined, float(min(0.5, np.quantile(good, 1 - KEEP_GOOD))))


def _features(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, content, metadata`` and the named columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = [[], []]
            for text, lang, source, n in zip(batch.column(1), *(batch.column(i).to_pylist() for i in (2, 3, 4))):
                text = text.as_py()
                views[0].append(content(text))
                views[1].append(metadata(text, lang, source, n))
            cols = [pa.array(v, pa.list_(pa.float64())) for v in views]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *cols, *batch.columns[5:]], names=["doc_id", "content", "metadata", *more])

    kinds = dict(docs.dtypes)
    schema = "doc_id bigint, content array<double>, metadata array<double>" + "".join(f", {c} {kinds[c]}" for c in more)
    return _columns(docs, *more).mapInArrow(run, schema)


def _columns(docs: DataFrame, *more: str) -> DataFrame:
    return texts(docs, F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("bigint"), *more)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> Model | None:
    """None unless both classes have some fitted and some held-back documents. Of two labels the worse counts."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("bigint").alias("_id"))
    known = known.agg(F.min(F.col("quality").cast("int")).alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(labelled)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    rows = _features(plain.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")), "_y").toPandas()
    some = plain.select(F.col("doc_id").alias("_id")).filter("_id is not null").orderBy(F.xxhash64("_id", F.lit(1)), "_id").limit(pool).distinct()
    rest = _features(plain.join(F.broadcast(some), F.col("doc_id") == F.col("_id"))).toPandas()
    rest = rest[~rest.doc_id.isin(set(rows.doc_id))]
    if len(rows) < 20:
        return None
    y = rows._y.to_numpy() > 0
    held = word_hashes([str(i) for i in rows.doc_id]) % np.uint64(4) == 0
    if any(len(np.unique(y[part])) < 2 for part in (held, ~held)):
        return None
    views = ["content", "metadata"]
    x = [np.stack(rows[v].to_numpy()) for v in views]
    u = [np.stack(rest[v].to_numpy()) if len(rest) else np.zeros((0, x[i].shape[1])) for i, v in enumerate(views)]
    return co_train(x, y, held, u)


def scored(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> DataFrame:
    """``doc_id, p_content, p_metadata, score, kept`` for every row; null texts are empty, null metadata is a value.

    Without usable labels of both classes every score is 0.5 and every document stays.
    """
    model = fit(docs, labels, labelled, pool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for text, lang, source, n in zip(batch.column(1), *(batch.column(i).to_pylist() for i in (2, 3, 4))):
                text = text.as_py()
                a.append(content(text))
                b.append(metadata(text, lang, source, n))
            if model and a:
                p, q, s = model([np.stack(a), np.stack(b)])
            else:
                p = q = s = np.full(len(a), 0.5)
            kept = s >= (model.threshold if model else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (p, q, s)), pa.array(kept, pa.bool_())],
                names=["doc_id", "p_content", "p_metadata", "score", "kept"])

    return _columns(docs).mapInArrow(run, "doc_id bigint, p_content double, p_metadata double, score double, kept boolean")
