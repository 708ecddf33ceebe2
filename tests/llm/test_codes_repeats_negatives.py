"""Grid codes, repeated windows and hard negatives against SQL and plain Python, with odd rows."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoledger.llm import gridcodes, negatives, registry, repeats
from tests.compare import connect, difference
from tests.llm.helpers import DOCS, SF, clashing, odd_documents

VECTORS = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("name", ["op11_grid_codes", "op12_repeats", "op13_hard_negatives"])
def test_queries_equal_sql(spark, name):
    assert difference(registry.queries()[name](spark, SF), connect(SF), registry.oracle_sql()[name]) is None


def odd_vectors(seed: int, n: int = 400, dim: int = 32):
    """Vectors with equal ones, ties, negatives, large parts and every unusable kind."""
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(0, 4)), (rng.integers(-40, 40, dim) / 64).tolist()) for i in range(n)]
    rows += [(n + i, 1, rows[3][2]) for i in range(40)]  # a crowd of copies
    rows += [(n + 50 + i, 2, (rng.normal(size=dim) * 300).tolist()) for i in range(10)]
    rows += [(5, 1, rows[5][2]), (5, 1, rows[5][2]), (100, 2, rows[3][2])]  # repeated keys
    nan, endless, nothing = ([x] + [0.5] * (dim - 1) for x in (float("nan"), float("-inf"), None))
    rows += [(1000, 1, nan), (1001, 1, endless), (1002, 1, nothing), (1003, 1, None), (1004, 1, []), (1005, 1, [70000.0] * dim)]
    rows += [(200, None, rows[7][2]), (None, 1, rows[8][2]), (1007, 3, [0.0] * dim), (1100, 3, [0.25] * 16), (1101, 2, [0.2] * 16)]
    return rows


def is_usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) and abs(x) < 65536 for x in v)


def whole(v):
    return [math.floor(256 * x) for x in v]


# grid codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    last = float("inf")
    rows = [r for r in rows if is_usable(r[2]) and len(r[2]) % parts == 0]
    rows.sort(key=lambda r: (last if r[0] is None else r[0], r[2]))
    rows = [r for r in rows if len(r[2]) == len(rows[0][2])]
    width = len(rows[0][2]) // parts
    cut = [[whole(r[2])[p * width : (p + 1) * width] for p in range(parts)] for r in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for c in cut:
                held[assign(p, c[p])[1]].append(c[p])
            for i, points in held.items():
                books[p][i] = [sum(column) // len(points) for column in zip(*points)]
    found = Counter()
    for r, c in zip(rows, cut):
        best = [assign(p, c[p]) for p in range(parts)]
        found[(r[0], tuple(i for _, i in best), tuple(d for d, _ in best))] += 1
    return found, hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()


@pytest.mark.parametrize("dim", [16, 32, 80])
def test_grid_codes_equal_plain_python(spark, dim):
    rows = odd_vectors(dim, 200, dim)
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in ("codes", "part_errors", "k", "v", "n", "part")})
    books = gridcodes.train_codebooks(frame.repartition(5))
    got = gridcodes.encode(frame, books).collect()
    want, digest = plain_codes(rows)
    assert books.sha256 == digest
    assert Counter((r.vec_id, tuple(r.codes), tuple(r.part_errors)) for r in got) == want


def test_grid_codes_of_few_and_no_rows(spark):
    frame = spark.createDataFrame([(2, 1, [1.0] * 16), (1, None, [-0.001] * 16), (1, None, [-0.001] * 16)], VECTORS)
    books = gridcodes.train_codebooks(frame)
    assert books.entries.shape == (16, 3, 1)
    assert sorted((r.vec_id, r.codes[0]) for r in gridcodes.encode(frame, books).collect()) == [(1, 0), (1, 0), (2, 2)]
    assert gridcodes.train_codebooks(frame.limit(0)) is None
    assert gridcodes.encode(frame.limit(0), books).collect() == []


@pytest.mark.parametrize("width,spread", [(1, 5), (2, 400), (4, 60), (4, 1 << 24), (48, 300)])
def test_memoised_cells_find_the_nearest(width, spread):
    rng = np.random.default_rng(width)
    book = rng.integers(-spread, spread, (64, width))
    book[40:44] = book[3]  # equal entries: the lowest index wins
    memo = {}
    for _ in range(2):
        points = np.concatenate([rng.integers(-2 * spread, 2 * spread, (3000, width)), book, book[3:4]])
        codes, errors = gridcodes.nearest(points, book, memo, 0)
        all_distances = ((points[:, None, :] - book) ** 2).sum(axis=2)
        assert (codes == all_distances.argmin(axis=1)).all() and (errors == all_distances.min(axis=1)).all()
    assert all(len(entries) for entries in memo.values())


def test_cells_whose_hash_agrees_are_told_apart(monkeypatch):
    class Zero:
        def integers(self, *_):
            return np.zeros(2, np.uint64) - np.uint64(1) >> np.uint64(1)  # one factor for all columns: (1, 2) and (2, 1) agree

    monkeypatch.setattr(np.random, "default_rng", lambda *_: Zero())
    rows, which = gridcodes.distinct_rows(np.array([[1, 2], [2, 1], [1, 2]]))
    assert (rows[which] == [[1, 2], [2, 1], [1, 2]]).all() and len(rows) == 2


# repeated windows


def plain_repeats(rows, size):
    words = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    first = {}
    for doc, w in words:
        for i in range(len(w) - size + 1):
            if doc is not None:
                k = tuple(w[i : i + size])
                first[k] = min(first.get(k, doc), doc)
    out = Counter()
    for doc, w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if doc is not None and first[tuple(w[i : i + size])] < doc:
                gone |= set(range(i, i + size))
        spans, start = [], None
        for i in range(len(w) + 1):
            if i in gone and start is None:
                start = i
            elif i not in gone and start is not None:
                spans.append((start, i))
                start = None
        out[(doc, len(w), tuple(spans), " ".join(x for i, x in enumerate(w) if i not in gone))] += 1
    return out


@pytest.mark.parametrize("chunk_words", [1, 500, 10**6])
def test_repeats_equal_plain_python(spark, monkeypatch, chunk_words):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 5_000)
    rng = np.random.default_rng(9)
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    rows += [(int(rng.integers(20, 90)), " ".join(f"w{rng.integers(0, 3)}" for _ in range(rng.integers(0, 60)))) for _ in range(150)]
    rows += [(100 + i, f"{passage}\tx{i}\n{passage} y{i}") for i in range(30)] + [(99, passage), (None, passage), (140, "a " * 500), (141, "a\x0b" * 300)]
    frame = clashing(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)).withColumns({c: F.lit(1) for c in ("doc", "h", "found", "known", "first")})
    got = repeats.remove_repeats(frame.repartition(7), 6, chunk_words=chunk_words).collect()
    assert Counter((r.doc_id, r.n_words, tuple((s.start, s.end) for s in r.spans), r.kept) for r in got) == plain_repeats(rows, 6)
    assert repeats.remove_repeats(frame.limit(0)).collect() == []


def test_chunks_send_every_window_once():
    rows = [(doc, repeats.word_hashes([b"a", b"b", b"c", b"d"])) for doc in (300, 1, 70000)]
    sent = list(repeats._chunk(rows, 3, 1))
    assert [(bucket, settled) for bucket, settled, *_ in sent] == [(0, True), (0, False)]
    (late, known), (docs, h) = (repeats._opened(*blob) for _, _, *blob in sent)
    assert sorted(late.tolist()) == [300, 300, 70000, 70000] and docs.tolist() == [1, 1]
    assert set(known.tolist()) == set(h.tolist()) and len(set(h.tolist())) == 2


# hard negatives


@pytest.mark.parametrize("spread", [3, 200, 1 << 12, 1 << 23])
def test_table_scores_are_inner_products(spread):
    rng = np.random.default_rng(spread)
    a, c = rng.integers(-spread, spread, (9, 19)), rng.integers(-spread, spread, (50, 19))
    planes = negatives.bit_planes(c)
    assert (negatives.scores(negatives.subset_sums(a, len(planes)), planes) == c @ a.T).all()
    assert (negatives.scores(negatives.subset_sums(a, 1), negatives.bit_planes(c * 0)) == 0).all()


def plain_negatives(rows):
    rows = [(i, label, whole(v)) for i, label, v in rows if i is not None and label is not None and is_usable(v)]
    out = Counter()
    for a, label, v in (r for r in rows if r[0] % 100 == 0):
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in rows if i != a and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            fit = [(-s, i) for s, i, other in scored if other != label and 80 * -ps <= 100 * -s <= 100 * -ps][:5]
            out.update((a, p, rank, i, -ps, s) for rank, (s, i) in enumerate(fit, 1))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives_equal_plain_python(spark, monkeypatch, seed):
    rows = odd_vectors(seed)
    rows += [(2000 + i, i % 3, (np.array(rows[100][2]) * (1 - i / 200)).tolist()) for i in range(60)]
    monkeypatch.setattr(negatives, "SLICE", 37)
    monkeypatch.setattr(negatives, "ANCHORS", 2)
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in ("place", "id", "dim", "block", "i", "v", "rank", "score")})
    got = negatives.hard_negatives(frame.repartition(4), F.col("vec_id") % 100 == 0).collect()
    assert Counter(tuple(r) for r in got) == plain_negatives(rows)
    assert len(got) > 50
    assert negatives.hard_negatives(frame.limit(0), F.lit(True)).collect() == []
    assert negatives.hard_negatives(frame, F.lit(False)).collect() == []
