"""Secrets by fixed patterns and by an inferred grammar of credentials.

Matches of the fixed patterns are labelled credentials. For each kind a prefix tree of their character classes is
generalised by merging states whose outgoing frequencies agree (Hoeffding bounds, red-blue order), which gives a
probabilistic automaton. Every token-like run of the texts that the fixed patterns leave in whole or in part is scored by
all automata. A run is reported as ``grammar`` if it is as likely, a symbol, as the labelled credentials of a kind, and
likelier than under the transitions between character classes in all words of the corpus: without that comparison a
long plain word, which has the likeliest symbols of a random key and no others, would pass. A token of letters, digits
and underscores that a fixed credential covers in part is the credential's own rest and is reported whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellcast.llm.common import staged, texts

# The patterns that always count, in their order, with the least length of what they hold.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ["assign", "access", "hex", "grammar"]
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
TOKEN = frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz")
SAMPLE = 300  # labelled credentials for each kind; the bound of the fit
LONGEST = 256  # of a labelled credential
ALPHA = 0.05  # of the Hoeffding bound
SHARE = 0.05  # of the labelled credentials may score below the threshold of their length
FLOOR = 1e-4  # probability of a symbol that a state never saw
MASK = "[SECRET]"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, end, kind, credential)`` by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def whole_tokens(text: str, taken: list[tuple]) -> list[tuple[int, int]]:
    """The tokens around fixed credentials that reach beyond their match."""
    out = set()
    for start, end, _, credential in taken:
        a, b = end - len(credential), end
        while a and text[a - 1] in TOKEN:
            a -= 1
        while b < len(text) and text[b] in TOKEN:
            b += 1
        if a < start or b > end:
            out.add((a, b))
    return sorted(out)


def candidates(text: str, taken: list[tuple]) -> list[tuple[int, int, str]]:
    """Token-like runs that the fixed matches do not cover whole."""
    covered: list[list[int]] = []
    for a, b, *_ in taken:
        if covered and a <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    out, i = [], 0
    for m in RUN.finditer(text):
        while i < len(covered) and covered[i][1] < m.end():
            i += 1
        if i == len(covered) or covered[i][0] > m.start():
            out.append((m.start(), m.end(), m[0]))
    return out


SYMBOLS = "dxlXU+/_=-"
_CLASS = {c: "d" for c in "0123456789"} | {c: "x" for c in "abcdef"} | {c: "l" for c in "ghijklmnopqrstuvwxyz"}
_CLASS |= {chr(c): "X" if c < 71 else "U" for c in range(65, 91)}


def classes(run: str) -> str:
    return "".join([_CLASS.get(c, c) for c in run])


def _bits(n: int, of: int) -> float:
    return math.log2(max(n / of, FLOOR)) if of else math.log2(FLOOR)


class Automaton:
    """States with counts: ``arcs[state][symbol] = (target, count)`` and ``ends[state]``."""

    def __init__(self, arcs: list[dict], ends: list[int]):
        self.arcs, self.ends, self.mean, self.slack = arcs, ends, 0.0, 0.0
        passed = [e + sum(n for _, n in out.values()) for e, out in zip(ends, arcs)]
        self.steps = [{s: (t, _bits(n, of)) for s, (t, n) in out.items()} for out, of in zip(arcs, passed)]
        self.stops = [_bits(e, of) for e, of in zip(ends, passed)]

    def likelihood(self, symbols: str) -> float:
        """Log2 probability a symbol, the end included."""
        state, total, unseen = 0, 0.0, math.log2(FLOOR)
        for s in symbols:
            step = self.steps[state].get(s)
            if step:
                state = step[0]
            total += step[1] if step else unseen
        return (total + self.stops[state]) / (len(symbols) + 1)


    def threshold(self, length: int) -> float:
        """Means of fewer symbols scatter more, by the root of their number."""
        return self.mean + self.slack / math.sqrt(length + 1)


class Background:
    """Transitions between the classes of neighbouring characters in all words; a word's first class follows a break."""

    def __init__(self, counts: list[int]):
        table = np.asarray(counts, dtype=float).reshape(len(SYMBOLS) + 1, -1)[:, 1:] + 1
        self.steps = {(a, b): _bits(n, row.sum()) for a, row in zip(" " + SYMBOLS, table) for b, n in zip(SYMBOLS, row)}

    def likelihood(self, symbols: str) -> float:
        """Log2 probability a symbol; the end counts as certain."""
        return sum(map(self.steps.__getitem__, zip(" " + symbols, symbols))) / (len(symbols) + 1)


def infer(strings: list[str], alpha: float = ALPHA) -> Automaton:
    """State merging over the prefix tree: red states stay, a blue one merges with the first compatible red one."""
    arcs: list[dict[str, list]] = [{}]
    ends = [0]
    for text in strings:
        state = 0
        for s in text:
            if s not in arcs[state]:
                arcs[state][s] = [len(arcs), 0]
                arcs.append({})
                ends.append(0)
            arcs[state][s][1] += 1
            state = arcs[state][s][0]
        ends[state] += 1
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def passed(q: int) -> int:
        return ends[q] + sum(n for _, n in arcs[q].values())

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            m, n = passed(p), passed(q)
            if not m or not n:
                continue
            far = bound * (1 / math.sqrt(m) + 1 / math.sqrt(n))
            if abs(ends[p] / m - ends[q] / n) > far:
                return False
            for s in arcs[p].keys() | arcs[q].keys():
                x, y = arcs[p].get(s), arcs[q].get(s)
                if abs((x[1] if x else 0) / m - (y[1] if y else 0) / n) > far:
                    return False
                if x and y and x[0] != y[0]:
                    todo.append((x[0], y[0]))
        return True

    def fold(a: int, b: int) -> None:
        """Adds the tree below b to a; b hangs below one red state only, which has let go of it."""
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            ends[p] += ends[q]
            for s, (target, n) in arcs[q].items():
                if s in arcs[p]:
                    arcs[p][s][1] += n
                    todo.append((arcs[p][s][0], target))
                else:
                    arcs[p][s] = [target, n]

    red = [0]
    while True:
        kept = set(red)
        blue = next(((r, s, x[0]) for r in red for s, x in sorted(arcs[r].items()) if x[0] not in kept), None)
        if blue is None:
            break
        r, s, b = blue
        to = next((q for q in red if compatible(q, b)), None)
        if to is None:
            red.append(b)
        else:
            arcs[r][s][0] = to
            fold(to, b)
    number = {q: i for i, q in enumerate(red)}
    return Automaton([{s: (number[t], n) for s, (t, n) in arcs[q].items()} for q in red], [ends[q] for q in red])


def train(strings: list[str]) -> Automaton:
    """An automaton with the scores, by length, that all but ``SHARE`` of its own credentials reach."""
    symbols = [classes(s) for s in sorted(strings)]
    out = infer(symbols)
    scores = [out.likelihood(s) for s in symbols]
    out.mean = sum(scores) / len(scores)
    out.slack = sorted((x - out.mean) * math.sqrt(len(s) + 1) for x, s in zip(scores, symbols))[int(SHARE * len(scores))]
    return out


def labelled(docs: DataFrame) -> DataFrame:
    """``kind, credential`` of every match of the fixed patterns in the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, found = [], []
            for text in batch.column(1):
                for _, _, kind, secret in base_spans(text.as_py()):
                    if len(secret) <= LONGEST:
                        kinds.append(kind)
                        found.append(secret)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(found, pa.string())], names=["kind", "credential"])

    return texts(docs).mapInArrow(run, "kind int, credential string")


def fit(credentials: DataFrame, sample: int = SAMPLE) -> list[Automaton]:
    """One automaton for each kind that has labelled credentials, from ``sample`` of them at most (least hashes)."""
    distinct = credentials.distinct()
    out = []
    for kind in range(3):
        rows = distinct.filter(F.col("kind") == kind).orderBy(F.md5("credential"), "credential").limit(sample).collect()
        if rows:
            out.append(train([r["credential"] for r in rows]))
    return out


def transitions(docs: DataFrame) -> Background:
    """Counted over all texts without their fixed matches; a partition adds one row of fixed length."""
    classed = np.zeros(256, np.int64)
    for c, kind in (_CLASS | {c: c for c in SYMBOLS if not c.isalpha()}).items():
        classed[ord(c)] = 1 + SYMBOLS.index(kind)
    width = len(SYMBOLS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for batch in batches:
            for text in batch.column(1):
                text = text.as_py()
                for a, b, *_ in base_spans(text):
                    text = text[:a] + " " * (b - a) + text[b:]
                kinds = classed[np.frombuffer(f" {text} ".encode(), np.uint8)]
                total += np.bincount(kinds[:-1] * width + kinds[1:], minlength=width * width)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n"])

    part = texts(docs).mapInArrow(run, "n array<bigint>")
    rows = part.select(F.posexplode("n").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect()  # at most 121
    counts = {r["at"]: r["n"] for r in rows}
    return Background([counts.get(i, 0) for i in range(width * width)])


def likely(run: str, automata: list[Automaton], plain: Background | None = None) -> bool:
    """As likely as labelled credentials, and likelier than in plain words."""
    symbols = classes(run)
    least = plain.likelihood(symbols) if plain else -math.inf
    return any((score := a.likelihood(symbols)) >= a.threshold(len(symbols)) and score > least for a in automata)


FOUND = "doc_id bigint, base array<string>, n array<bigint>, runs array<struct<start:bigint,end:bigint,run:string>>, whole array<struct<start:bigint,end:bigint>>"


def findings(docs: DataFrame) -> DataFrame:
    """Fixed matches and scored-later runs of every row, in one pass over the texts."""
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("run", pa.string())]))
    whole_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, numbers, runs, whole, held = [], [], [], [], []
            for text in batch.column(1):
                text = text.as_py()
                base = base_spans(text)
                spans.append([f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted((a, k, b) for a, b, k, _ in base)])
                numbers.append([sum(x[2] == k for x in base) for k in range(3)])
                runs.append([{"start": a, "end": b, "run": r} for a, b, r in candidates(text, base)])
                whole.append([{"start": a, "end": b} for a, b in whole_tokens(text, base)])
                held.append([{"kind": k, "credential": c} for _, _, k, c in base if len(c) <= LONGEST])
            kinds = pa.list_(pa.struct([("kind", pa.int32()), ("credential", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(pa.string())), pa.array(numbers, pa.list_(pa.int64())), pa.array(runs, run_type),
                 pa.array(whole, whole_type), pa.array(held, kinds)],
                names=["doc_id", "base", "n", "runs", "whole", "held"])

    return texts(docs).mapInArrow(run, FOUND + ", held array<struct<kind:int,credential:string>>")


def _place(span: str) -> tuple[int, int, int]:
    kind, start, end = span.split(":")
    return int(start), KINDS.index(kind), int(end)


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row; a null or empty text has none.

    Offsets are code points, ends exclusive; a grammar span may hold or overlap fixed ones, which stay. Without labelled
    credentials there is no grammar and only fixed matches.
    """
    rows = staged(findings(docs), "findings")
    automata = fit(rows.select(F.explode("held").alias("h")).select("h.kind", "h.credential"), sample)
    plain = transitions(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for base, n, runs, whole in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4))):
                found = {(w["start"], w["end"]) for w in whole}
                found |= {(r["start"], r["end"]) for r in runs if likely(r["run"], automata, plain)}
                more = [f"grammar:{a}:{b}" for a, b in found]
                spans = sorted(base + more, key=_place) if more else base
                digest = hashlib.sha256(",".join(base).encode()).hexdigest()
                for col, value in zip(out, (*n, digest, ",".join(spans))):
                    col.append(value)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return rows.select("doc_id", "base", "n", "runs", "whole").mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def masked_text(text: str, automata: list[Automaton], plain: Background | None = None, mask: str = MASK) -> str:
    """Overlapping spans are masked as one."""
    base = base_spans(text)
    spans = [(a, b) for a, b, _, _ in base] + whole_tokens(text, base)
    spans += [(a, b) for a, b, r in candidates(text, base) if likely(r, automata, plain)]
    out, at = [], 0
    for a, b in sorted(spans):
        if b > at:
            if a >= at:
                out += [text[at:a], mask]
            at = b
    return "".join([*out, text[at:]]) if out else text


def masked(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, with secrets replaced in ``text`` (``n_chars`` follows, where there is one). Null stays null."""
    automata, plain = fit(staged(labelled(docs), "credentials"), sample), transitions(docs)
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [None if t is None else masked_text(t, automata, plain) for t in batch.column(at).to_pylist()]
            out = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            if size is not None:
                counts = pa.array([None if t is None else len(t) for t in new], out.schema.field(size).type)
                out = out.set_column(size, out.schema.field(size), counts)
            yield out

    return docs.mapInArrow(run, docs.schema)
