"""Vectors, SimHash, components, URL lists and the pipeline against brute force, with odd rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from geoledger.llm import lattice, quality, simhash, urls
from geoledger.llm.components import component_labels
from tests.llm.helpers import SF, clashing, odd_documents, plain_components

# components


def test_components_of_chains_stars_and_random_links(spark):
    chain = [(i, i + 1) for i in range(1000, 1200)]
    star = [(5000, 5000 + i) for i in range(1, 300)]
    rng = np.random.default_rng(3)
    loose = rng.integers(0, 900, (500, 2)).tolist()
    links = chain + star + loose + [(7, 7), (5, 6), (5, 6), (6, 5)]
    labels = {r.id: r.component_id for r in component_labels(spark.createDataFrame(links, "a long, b long")).collect()}
    plain = plain_components(6000, links)
    assert all(plain[i] == c for i, c in labels.items())
    assert set(labels) == {x for a, b in links if a != b for x in (a, b)}
    assert component_labels(spark.createDataFrame([], "a long, b long")).collect() == []


# simhash


def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_posting_sets_cover_every_agreement():
    for bits in range(0, 6):
        sets = simhash.posting_positions(bits)
        for agree in combinations(range(8), 8 - bits):
            assert any(set(s) <= set(agree) for s in sets)


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40).tolist()
    values = set(base)
    for v in base:
        for _ in range(12):
            w = v
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                w ^= 1 << int(b)
            values.add(w)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    got = Counter((r.a, r.b) for r in simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect())
    want = {(min(a, b), max(a, b)) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert set(got) == want and set(got.values()) == {1} and len(want) > 100


def test_simhash_query_equals_brute_force(spark):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    prints = [plain_fingerprint(r.text) for r in docs]
    links = [(a, b) for a, b in combinations(range(len(docs)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = plain_components(len(docs), links)
    got = {r.doc_id: r for r in simhash.op5_simhash(spark, SF).collect()}
    for n, r in enumerate(docs):
        assert got[r.doc_id].fingerprint == f"{prints[n]:016x}" and got[r.doc_id].component_id == docs[roots[n]].doc_id


def test_simhash_of_odd_rows(spark):
    docs = clashing(odd_documents(spark))
    rows = simhash.simhash_groups(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[3].fingerprint == by[4].fingerprint == by[5].fingerprint == "0" * 16 and by[5].component_id == 3
    assert by[2].component_id == 1 and by[7].fingerprint == f"{plain_fingerprint(docs.where('doc_id = 7').first().text):016x}"
    kept = simhash.keep_one_of_each(docs).collect()
    assert Counter(r.doc_id for r in kept) == {1: 1, 3: 1, 6: 1, 7: 1, 8: 1, None: 2}
    assert simhash.simhash_groups(docs.limit(0)).collect() == []
    assert simhash.keep_one_of_each(docs).columns == docs.columns and simhash.keep_one_of_each(docs.limit(0)).collect() == []


def test_unlike_texts_of_one_id_are_both_kept(spark):
    red, blue = (" ".join(f"{c}{i}" for i in range(60)) for c in ("red", "blue"))
    rows = [(5, red), (5, blue), (5, blue), (6, blue), (4, "green " * 9), (9, None), (9, "")]
    kept = simhash.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text or "") for r in kept) == {(5, red): 1, (5, blue): 1, (4, "green " * 9): 1, (9, ""): 1}


# vectors


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 8)) * 2
    found = lattice.e8_decode(x) / 2
    moves = lattice.e8_neighbours() / 2
    assert len(moves) == 240 and np.allclose((moves**2).sum(axis=1), 2)
    best = ((x - found) ** 2).sum(axis=1)
    assert all((((x - found - m) ** 2).sum(axis=1) >= best - 1e-9).all() for m in moves)


def brute_vectors(rows, least=0.95):
    usable = {}
    for n, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            u = np.array(v, float) / np.abs(v).max()
            usable[n] = u / np.linalg.norm(u)
    return [(a, b) for a, b in combinations(usable, 2) if len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= least]


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(60):
        v = rng.normal(size=64)
        rows.append(v.tolist())
        for cos in (0.999, 0.97, 0.955, 0.93):
            noise = rng.normal(size=64)
            noise -= noise @ v / (v @ v) * v
            noise *= np.linalg.norm(v) / np.linalg.norm(noise)
            rows.append((3.0 * (cos * v + math.sqrt(1 - cos * cos) * noise)).tolist())
        rows.append(v.tolist())
    rows += [None, [], [0.0] * 64, [1.0, None], [float("nan")] * 64, [float("inf")] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0], [1e300, 2e300]]
    numbered = list(enumerate(rows))
    frame = spark.createDataFrame(numbered, "vec_id long, embedding array<double>").withColumn("unit", F.lit(1)).withColumn("cls", F.lit("x"))
    got = lattice.near_vectors(frame).collect()
    links = brute_vectors(numbered)
    degree = Counter(x for pair in links for x in pair)
    assert len(got) == len(rows)
    found, true = sum(r.n_links for r in got), sum(degree.values())
    assert 0.97 * true <= found <= true and all(r.n_links <= degree[r.vec_id] for r in got)
    roots = plain_components(len(rows), links)
    assert sum(r.component_id == roots[r.vec_id] for r in got) >= 0.97 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    tail = {r.vec_id: r.n_links for r in got if r.vec_id >= 360}
    assert [tail[360 + i] for i in range(9)] == [0, 0, 0, 0, 0, 0, 2, 2, 2]
    assert lattice.near_vectors(frame.limit(0)).collect() == []


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    true = Counter(x for pair in brute_vectors(rows) for x in pair)
    got = {r.vec_id: r.n_links for r in lattice.op1_near_vectors(spark, "/root/testdata/sf0.01").collect()}
    assert sum(got.values()) >= 0.9 * sum(true.values()) and all(n <= true[v] for v, n in got.items())


def test_repeated_and_missing_ids(spark):
    frame = spark.createDataFrame([(4, [1.0, 2.0]), (4, [1.0, 2.0]), (None, [1.0, 2.0]), (None, None)], "vec_id long, embedding array<double>")
    got = lattice.near_vectors(frame).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got)[1:] == [(0, 2, 4, True), (4, 2, 4, True), (4, 2, 4, True)]


# URL lists

DAY = datetime.date(2024, 1, 1)


def entry(name, kind, pattern, action, day):
    return (name, kind, pattern, action, None if day is None else DAY + datetime.timedelta(day))


def brute_verdict(host, day, entries):
    best = None
    for name, kind, pattern in {e[:3] for e in entries if None not in e[:3]}:
        if host != pattern and not host.endswith("." + pattern):
            continue
        dated = sorted({e[4] for e in entries if e[:3] == (name, kind, pattern) and e[4] and e[3] in ("add", "remove") and e[4] <= day})
        if dated and any(e[:3] == (name, kind, pattern) and e[4] == dated[-1] and e[3] == "add" for e in entries):
            rank = (-len(pattern), kind != "block", name)
            best = min(best or (rank, None, None), (rank, kind, pattern)) if best else (rank, kind, pattern)
    return (best[1], best[2]) if best else ("none", None)


def test_url_filter_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "c.b.org", "com"]
    entries = [
        entry(["l1", "l2"][rng.integers(2)], ["block", "allow"][rng.integers(2)], hosts[rng.integers(6)], ["add", "remove"][rng.integers(2)], int(rng.integers(0, 40)))
        for _ in range(60)
    ]
    entries += [entry("l1", "block", "a.com", "add", 20), entry("l1", "block", "a.com", "remove", 20), entry(None, "block", "a.com", "add", 1), entry("l1", "block", "b.org", "drop", 1), entry("l1", "block", "b.org", "add", None)]
    captures = [(i, f"HTTPS://user@{hosts[rng.integers(5)].upper()}:80/p?q#f", DAY + datetime.timedelta(int(rng.integers(0, 45)))) for i in range(300)]
    frame = spark.createDataFrame(captures, "page_id long, url string, fetched_on date")
    lists = spark.createDataFrame(entries, "list_name string, kind string, pattern string, action string, dated date")
    rows = urls.filter_urls(clashing(frame), lists).collect()
    assert len(rows) == 300
    for r in rows:
        assert (r.verdict, r.pattern) == brute_verdict(r.host, r.fetched_on, entries)
        assert r.verdict == "none" or r.valid_from <= r.fetched_on and (r.valid_to is None or r.fetched_on < r.valid_to)


def test_url_filter_of_odd_rows(spark):
    frame = spark.createDataFrame([(1, None, DAY), (2, "no url", DAY), (3, "http://a.com/", None), (4, "http://a.com/", DAY), (4, "http://a.com/", DAY)], "page_id long, url string, fetched_on date")
    lists = spark.createDataFrame([entry("l", "block", "a.com", "add", 0)], "list_name string, kind string, pattern string, action string, dated date")
    assert Counter((r.page_id, r.verdict) for r in urls.filter_urls(frame, lists).collect()) == {(1, "none"): 1, (2, "none"): 1, (3, "none"): 1, (4, "block"): 2}
    assert {r.verdict for r in urls.filter_urls(frame, lists.limit(0)).collect()} == {"none"}
    assert urls.filter_urls(frame.limit(0), lists).collect() == []


def test_url_filter_by_time_and_path(spark):
    """Instants within a day, paths, and patterns as lists write them; every internal name is also a column."""
    rng = np.random.default_rng(11)
    start = datetime.datetime(2024, 1, 5)
    instant = lambda: start + datetime.timedelta(minutes=15 * int(rng.integers(0, 200)))
    written = {
        "example.com": ["Example.com", "example.com.", "http://u@EXAMPLE.com:80/?q", "example.com/"],
        "a.example.com": ["A.example.com"], "example.com/bad": ["https://example.com/bad/", "EXAMPLE.com/bad#x"],
        "a.example.com/bad/x": ["a.example.com./bad/x?y=1"], "[::1]": ["http://[::1]:8080/", "[::1]"],
    }
    entries = []
    for _ in range(120):
        pattern = list(written)[rng.integers(len(written))]
        raw = written[pattern][rng.integers(len(written[pattern]))]
        entries.append((["l1", "l2"][rng.integers(2)], ["block", "allow"][rng.integers(2)], pattern, ["add", "remove"][rng.integers(2)], instant(), raw))
    urls_seen = ["http://example.com/bad/x", "http://example.com./y", "https://A.Example.com/bad/x/", "http://a.example.com/bad", "http://example.com/badly", "http://[::1]:99/z", "http://b.example.com/bad/x", "http://example.com"]
    captures = [(i, urls_seen[rng.integers(len(urls_seen))], instant()) for i in range(400)]
    frame = spark.createDataFrame(captures, "page_id long, url string, fetched_on timestamp")
    names = ["path", "at", "day", "row", "begun", "moment", "best", "found", "_host", "_day", "place", "valid_to"]
    lists = spark.createDataFrame([(*e[:2], e[5], *e[3:5]) for e in entries], "list_name string, kind string, pattern string, action string, dated timestamp")

    def plain(url, at):
        rest = url.split("://")[1]
        host, _, path = rest.partition("/")
        host = host[: host.index("]") + 1] if "]" in host else host.split(":")[0].lower().rstrip(".")
        path = ("/" + path).rstrip("/")
        best = None
        for name, kind, pattern in {e[:3] for e in entries}:
            ph, _, pp = pattern.partition("/")
            if (host != ph and not host.endswith("." + ph)) or (pp and path != "/" + pp and not path.startswith(f"/{pp}/")):
                continue
            times = sorted({e[4] for e in entries if e[:3] == (name, kind, pattern) and e[4] <= at})
            if times and any(e[:3] == (name, kind, pattern) and e[4] == times[-1] and e[3] == "add" for e in entries):
                rank = (-len(pattern), kind != "block", name)
                best = min(best, (rank, kind, pattern, times[-1])) if best else (rank, kind, pattern, times[-1])
        return best[1:] if best else ("none", None, None)

    rows = urls.filter_urls(frame.withColumns({n: F.lit("clash") for n in names}), lists).collect()
    assert len(rows) == 400 and rows[0]["begun"] == "clash"
    for r in rows:
        assert (r.verdict, r.pattern, r.valid_from) == plain(r.url, r.fetched_on)
    assert len({(r.verdict, r.pattern) for r in rows}) > 8


def test_an_entry_removed_the_same_day_is_gone_the_next(spark):
    at = lambda day, hour: datetime.datetime(2024, 1, day, hour)
    lists = spark.createDataFrame([("l", "block", "a.com", "add", at(5, 20)), ("l", "block", "a.com", "remove", at(5, 23))], "list_name string, kind string, pattern string, action string, dated timestamp")
    seen = [at(5, 8), at(5, 20), at(5, 22), at(5, 23), at(6, 0), at(6, 8)]
    frame = spark.createDataFrame([(i, "http://a.com/", t) for i, t in enumerate(seen)], "page_id long, url string, fetched_on timestamp")
    assert [r.verdict for r in urls.filter_urls(frame, lists).orderBy("page_id").collect()] == ["none", "block", "block", "none", "none", "none"]


@pytest.mark.parametrize("name", ["op2_url_filter", "op3_mix", "op8_fingerprints"])
def test_native_plans(spark, name):
    from geoledger.llm import registry

    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# pipeline


def test_stages_keep_columns_and_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "SimHash near-dedup", "mixing sources to target weights", "SentencePiece encoding and decoding"]
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, SF)
        assert out.columns == docs.columns
    model = quality.train(docs, labels)
    differ = quality.Differ(model.good, model.bad)
    kept = sorted((r for r in docs.collect() if model.score(differ.difference(r.text)) >= 0.3), key=lambda r: r.doc_id)
    prints = [plain_fingerprint(r.text) for r in kept]
    links = [(a, b) for a, b in combinations(range(len(kept)), 2) if (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = plain_components(len(kept), links)
    first = {kept[n].doc_id for n in range(len(kept)) if roots[n] == n}
    near = stages["SimHash near-dedup"](spark, stages["quality classifier"](spark, docs, SF), SF)
    assert sorted(r.doc_id for r in near.collect()) == sorted(first)
    mixed = Counter(r.doc_id for r in out.collect())
    assert set(mixed) <= first
    final = corpus_pipeline.run(spark, SF)
    assert Counter(r.doc_id for r in final.collect()) == mixed


def test_stages_take_odd_rows(spark):
    docs = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert 0 < docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_documents(spark).limit(0), SF).count() == 0
