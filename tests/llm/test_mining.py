"""Collocations, hard negatives and repeated passages against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellcast.llm import collocations, quotient, repeated_passages, suffix_groups, threshold_search


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("bits", [1, 5, 13, 24, 40, 61, 64])
def test_quotient_filters_lose_nothing(bits):
    rng = np.random.default_rng(bits)
    x = rng.integers(0, (1 << bits) - 1 if bits < 64 else (1 << 64) - 1, 300, dtype=np.uint64, endpoint=True)
    y = quotient.permute(x, bits)
    assert (quotient.restore(y, bits) == x).all() and len(np.unique(y)) == len(np.unique(x))
    keys, counts = quotient.counted(y)
    counts = counts * rng.integers(1, 400, len(counts))
    back = quotient.decode(quotient.encode(keys, counts, bits))
    assert (back[0] == keys).all() and (back[1] == counts).all()
    half = len(keys) // 2
    both = quotient.merged([(keys[:half + 1], counts[:half + 1]), (keys[half:], counts[half:])])
    assert (both[0] == keys).all() and both[1].sum() == counts.sum() + counts[half]


def test_empty_filters_and_packed_integers():
    none = np.zeros(0, dtype=np.uint64)
    assert [len(x) for x in quotient.decode(quotient.encode(none, none.astype(np.int64), 20))] == [0, 0]
    for v in ([], [0], [5, 300, 1 << 40], [-3, 7]):
        assert quotient.unpack(quotient.pack(np.array(v, dtype=np.int64))).tolist() == v


def brute_collocations(rows, least, top, share):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, 6):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in some.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and p[i:j] in some and 100 * a >= share * some[p[i:j]]}
        best = []
        for p, a in some.items():
            if p not in gone:
                score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out, key=repr)


PHRASES = "lang string, text string, Doc_id int, block int, words string, n double"


def phrase_rows():
    rng = random.Random(8)
    words = ["a", "b", "New", "york", "Ünïcode", "ÄÖ", "\x00z", "e\xa0f", "\x1cq", "日本"]
    rows = [(rng.choice(["en", "en", "de", None, "und", ""]), " ".join(rng.choices(words, [9, 7, 5, 5, 2, 2, 1, 1, 1, 1], k=rng.randint(0, 40)))
             .replace("a b", rng.choice(["a b", "a, b", "a\tb", "a\nb", "a.b"]))) for _ in range(300)]
    rows += [("en", "new york new york " * 30), ("en", None), (None, ""), ("en", "x " * 400), ("de", "tail. " * 3)] * 2
    return [(*r, 1, 2, "w", 0.5) for r in rows]


@pytest.mark.parametrize("share", [100, 60])
def test_collocations(spark, share, monkeypatch):
    rows = phrase_rows()
    monkeypatch.setattr(collocations, "ENTRIES", 16)  # many ranges
    monkeypatch.setattr(collocations, "WORDS", 3)
    got = collocations.collocations(spark.createDataFrame(rows, PHRASES).repartition(3), least=6, top=40, share=share).collect()
    want = brute_collocations([r[:2] for r in rows], 6, 40, share)
    assert ordered(got) == want and len(want) > 60


def test_collocations_of_little(spark):
    for rows in ([], [(None, None, 1, 2, "w", 0.5)], [("en", "one two three", 1, 2, "w", 0.5)]):
        assert collocations.collocations(spark.createDataFrame(rows, PHRASES)).collect() == []


def brute_negatives(vectors, anchors):
    out = []
    width = max((len(v) for _, _, v in vectors), default=0)
    x = [(i, y, [*v, *[0] * (width - len(v))]) for i, y, v in vectors]
    for i, y, v in x:
        if not anchors(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in x if j != i]
        for s, p, _ in sorted((t for t in scored if t[2] == y), key=lambda t: (-t[0], t[1]))[:5]:
            fit = sorted((t for t in scored if t[2] != y and 30 * s <= 100 * t[0] <= 90 * s), key=lambda t: (-t[0], t[1]))[:10]
            out += [(i, p, r, j, s, t) for r, (t, j, _) in enumerate(fit, start=1)]
    return sorted(out, key=repr)


VECTORS = "vec_id bigint, embedding array<float>, label int, row string, parts int"


@pytest.mark.parametrize("block", [7, 4096])
def test_hard_negatives(spark, block, monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(threshold_search, "BLOCK", block)
    monkeypatch.setattr(threshold_search, "PACK", block)
    monkeypatch.setattr(threshold_search, "FIRST", 1)
    rows = [(i, (rng.normal(size=6) + i % 3).tolist(), i % 3, "r", 1) for i in range(120)]
    rows += [(200 + i, rows[5][1], i % 2, "r", 1) for i in range(30)]  # copies
    rows += [(300, [0.0] * 6, 1, "r", 1), (301, [1.0, 2.0], 1, "r", 1), (302, [], 0, "r", 1), rows[4], (303, [3e4] * 6, 2, "r", 1)]
    bad = [(400, None, 1, "r", 1), (401, [1.0, None], 1, "r", 1), (402, [float("nan")] * 6, 1, "r", 1), (403, [float("inf")] * 6, 1, "r", 1),
           (404, [1.0] * 6, None, "r", 1), (None, [1.0] * 6, 1, "r", 1)]
    df = threshold_search.prepared(spark.createDataFrame(rows + bad, VECTORS).repartition(4))
    got = threshold_search.hard_negatives(df, df.filter("vec_id % 4 = 0")).collect()
    whole = {(i, y, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v, y, _, _ in rows}
    want = brute_negatives([(i, y, list(v)) for i, y, v in whole], lambda i: i % 4 == 0)
    assert ordered(got) == want and len(want) > 500


def test_hard_negatives_of_nothing_and_of_huge_vectors(spark):
    empty = threshold_search.prepared(spark.createDataFrame([], VECTORS))
    assert threshold_search.hard_negatives(empty, empty).collect() == []
    rows = [(0, [1e18, 1.0], 0, "r", 1), (1, [1e18, 2.0], 0, "r", 1), (2, [5e17, 0.0], 1, "r", 1)]
    df = threshold_search.prepared(spark.createDataFrame(rows, VECTORS.replace("float", "double")))
    got = threshold_search.hard_negatives(df, df.filter("vec_id = 0")).collect()
    assert [(r.negative_id, r.positive_score) for r in got] in ([], [(2, (1 << 63) - 1)])


def test_reading_of_lists_ends_early():
    rng = np.random.default_rng(1)
    rows = np.r_[rng.integers(-50, 50, (4000, 4)), rng.integers(2000, 2500, (30, 4))]
    lists = threshold_search.Lists(rows, 10)
    read = []
    lists.rows = type("Seen", (), {"__getitem__": lambda s, i: read.append(i) or rows.astype(float)[i], "__len__": lambda s: len(rows), "dtype": np.dtype(float)})()
    (got,) = lists.best(np.array([3, 1, 2, 1]), np.ones(len(rows), dtype=bool), [(-10**9, 10**9)], 5)
    want = sorted(rows @ np.array([3, 1, 2, 1]))[-5]
    assert min(s for s, _ in got) == want and sum(len(i) for i in read if isinstance(i, np.ndarray)) < 400


@pytest.mark.parametrize("small", [0, 24])
def test_suffix_arrays(small, monkeypatch):
    monkeypatch.setattr(suffix_groups, "SMALL", small)
    rng = random.Random(small)
    for _ in range(400):
        text = [rng.randrange(rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(0, 60))] * rng.randint(1, 3)
        assert suffix_groups.suffix_array(np.array(text, dtype=np.int64)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def brute_passages(rows):
    last = 1 << 63
    texts = [(last if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for s in range(len(t) - 49):
            first[t[s:s + 50]] = min(first.get(t[s:s + 50], last), i)
    out = []
    for (i, t), (id_, _) in zip(texts, rows):
        gone = [False] * len(t)
        for s in range(len(t) - 49):
            if first[t[s:s + 50]] < i:
                gone[s:s + 50] = [True] * 50
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out.append((id_, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


DOCS = "doc_id bigint, text string, block int, Shard string, bytes double"


def passage_rows():
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(n))
    base = [prose(rng.randint(5, 120)) for _ in range(25)]
    notice = prose(20)
    texts = [*base, None, "", "x" * 49, "x" * 50, "x" * 500, "x" * 900, "ab" * 300, "ab" * 31, notice[:50], notice[1:51] + "!", base[3], base[3], prose(4000)]
    for t in base[:12]:  # near copies, shared passages at text ends and side by side
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        texts += [" ".join(words), prose(5) + notice, notice + " " + t[:80], base[5][-70:] + base[6][:70]]
    texts += [f"{notice}{i}{prose(3)}" for i in range(20)]
    rows = [(rng.choice([-5, 1000, 7]) + i if i % 9 else 500, t) for i, t in enumerate(texts)]
    return rows + [(None, base[0]), (None, base[1] + " tail of a row without an id that is long enough to count"), (None, base[1]), rows[2], rows[2]]


@pytest.mark.parametrize("hot,small", [(1 << 15, False), (3, True)])
def test_repeated_passages(spark, hot, small, monkeypatch):
    if small:
        for name, value in (("BLOCK", 3000), ("ENTRIES", 200), ("CONTEXTS", 50)):
            monkeypatch.setattr(repeated_passages, name, value)
    rows = passage_rows()
    docs = spark.createDataFrame([(*r, 1, "s", 0.5) for r in rows], DOCS).repartition(4)
    got = [(r[0], *r[1:4], bytes(r[4])) for r in repeated_passages.without_repeats(docs, hot).collect()]
    want = brute_passages(rows)
    assert sorted(got, key=repr) == want and sum(w[3] for w in want) > 60


def test_repeated_passages_of_little(spark):
    for rows in ([], [(1, None)], [(1, "short"), (2, "short")]):
        got = repeated_passages.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        assert sorted((r[0], r[2], bytes(r[4])) for r in got) == [(i, 0, (t or "").encode()) for i, t in rows]


def test_contexts_of_one_key_are_compared_string_by_string():
    rng = random.Random(1)
    pieces = [bytes(rng.choices(b"ab", k=rng.randint(50, 70))) + b"c" * rng.randint(40, 90) for _ in range(40)]
    pieces += [p[:rng.randint(50, len(p))] for p in pieces[:20]] + [b"%02d" % i * 40 for i in range(5)]
    keys = np.array([0] * 60 + [1, 2, 3, 4, 5], dtype=np.uint64)
    docs = np.array([rng.randrange(-9, 99) for _ in pieces])
    want = [[min(int(docs[j]) for j, q in enumerate(pieces) if p[s:s + 50] in q) for s in range(len(p) - 49)] for p in pieces]
    for limit in (1, 1000, 1 << 20):
        got = repeated_passages.least_documents(keys, pieces, docs, limit)
        assert [g.tolist() for g in got] == want
