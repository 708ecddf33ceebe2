"""Shards, mixture, fingerprints, tokens, language and quality scores against plain Python, with odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from geoledger.llm import counts, language, mixing, pieces, quality, registry, sharding, winnowing
from geoledger.sources.scratch import scratch_path
from tests.compare import connect, difference
from tests.llm.helpers import DOCS, SF, clashing, odd_documents


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert difference(registry.queries()[name](spark, SF), connect(SF), registry.oracle_sql()[name]) is None


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registry.queries()) == list(range(1, 14))


# sharding


def check_shards(rows, n_shards=24):
    sizes, slots, largest = Counter(), defaultdict(list), 0
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        largest = max(largest, r.size)
    target = sum(sizes.values()) / n_shards
    assert all(abs(sizes[s] - target) <= largest for s in range(n_shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    keyed = [(r.doc_id if r.doc_id is not None else -1, r.shard) for r in rows]
    assert [s for _, s in sorted(keyed)] == sorted(s for _, s in keyed)


def test_shards_are_contiguous_and_balanced(spark):
    rows = sharding.op9_shards(spark, SF).collect()
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    assert len(rows) == len(texts) and {r.doc_id for r in rows} == set(texts)
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    check_shards(rows)


def test_shards_equal_a_plain_prefix_sum(spark):
    rows = {r.doc_id: r for r in sharding.op9_shards(spark, SF).collect()}
    sizes = {r.doc_id: len((r.text or "").encode()) + 8 for r in documents(spark).collect()}
    total, end, slots = sum(sizes.values()), 0, Counter()
    for doc in sorted(sizes):
        end += sizes[doc]
        shard = min((2 * end - sizes[doc]) * 24 // (2 * total), 23)  # where the middle of its bytes lies
        assert (rows[doc].size, rows[doc].shard, rows[doc].slot) == (sizes[doc], shard, slots[shard])
        slots[shard] += 1
    assert len(rows) == len(sizes)


def test_shards_of_odd_rows(spark):
    docs = odd_documents(spark)
    rows = sharding.assign_shards(clashing(docs), 3).collect()
    assert len(rows) == docs.count()
    assert sum(r.size for r in rows) == sum(8 + len((r.text or "").encode()) for r in docs.collect())
    assert sharding.assign_shards(docs.limit(0)).collect() == []


def test_one_key_with_all_rows_is_split(spark):
    rows = sharding.assign_shards(spark.range(960).select(F.lit(5).alias("doc_id"), F.lit("same").alias("text"))).collect()
    assert Counter(Counter(r.shard for r in rows).values()) == {40: 24}


def test_written_shards(spark):
    path = scratch_path(spark, "written")
    sharding.write_shards(documents(spark), path, 4)
    back = spark.read.parquet(path)
    assert back.count() == 200 and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


# mixing


def test_mixture_equals_plain_inversion(spark):
    docs = documents(spark).where("source in ('src0', 'src1', 'src2')")
    weights = spark.createDataFrame([("src0", 30.0), ("src1", 1.0), ("gone", 2.0)], "source string, weight double")
    rows = mixing.mix_sources(docs, weights, total_bytes=2_000_000, seed=9).collect()
    size, total = defaultdict(int), 2_000_000
    for r in docs.collect():
        size[r.source] += len(r.text.encode()) + 1
    want = {}
    for r in docs.collect():
        rate = {"src0": 30.0, "src1": 1.0}.get(r.source, 0.0) / 31.0 * total / size[r.source]
        parts, n = max(1, math.ceil(rate / 8)), 0
        for j in range(1, parts + 1):
            u = int(hashlib.md5(f"9|{r.doc_id}|{j}".encode()).hexdigest()[:13], 16) / 2**52
            p = c = math.exp(-rate / parts)
            k = 0
            while c <= u:
                k += 1
                p *= rate / parts / k
                c += p
                n += 1
        want[r.doc_id] = n
    got = Counter(r.doc_id for r in rows)
    assert {k: v for k, v in want.items() if v} == dict(got)
    assert max(want.values()) > 20 and all(r.n_copies == got[r.doc_id] for r in rows)
    assert {(r.doc_id, r.copy) for r in rows} == {(d, c) for d, n in got.items() for c in range(n)}


def test_mixture_reaches_its_weights(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("ten bytes!").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("source"))
    weights = spark.createDataFrame([("hot", 1.0), ("b", 4.0)], "source string, weight double")
    share = {r.source: r["count"] for r in mixing.mix_sources(docs, weights).groupBy("source").count().collect()}
    assert abs(share["hot"] / sum(share.values()) - 0.2) < 0.02 and abs(sum(share.values()) - 20_000) < 500


def test_mixture_of_odd_rows(spark):
    docs = clashing(odd_documents(spark))
    weights = spark.createDataFrame([(None, 5.0), ("a", 1.0), ("b", -1.0), ("c", None)], "source string, weight double")
    mixed = mixing.mix_sources(docs, weights, total_bytes=400)
    rows = mixed.collect()
    assert {r.source for r in rows} <= {None, "a"} and None in {r.source for r in rows}
    assert mixed.columns.count("copy") == 1 and all(isinstance(r.copy, int) for r in rows)
    assert mixing.mix_sources(docs.limit(0), weights).collect() == []


# winnowing


def plain_hash(spark, grams):
    values = spark.createDataFrame([(i, list(g)) for i, g in enumerate(grams)], "i int, g array<string>")
    return {r.i: r.h & 0xFFFFFFFF for r in values.select("i", F.hash(*[F.expr(f"get(g, {j})") for j in range(winnowing.GRAM)]).alias("h")).collect()}


def test_winnowing_equals_plain_windows(spark):
    import regex

    docs = odd_documents(spark).unionByName(documents(spark).limit(20)).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = winnowing.fingerprint_documents(docs).collect()
    for r in rows:
        if r.text and len(r.text) > 20_000:
            continue
        found = regex.findall(r"[\p{L}\p{N}]{1,3}|[^\p{L}\p{N}\s]", r.text or "")
        grams = [found[i : i + 6] for i in range(max(len(found) - 5, 1))] if found else []
        h = plain_hash(spark, grams) if grams else {}
        want = []
        for start in range(max(len(grams) - 7, 1) if grams else 0):
            window = range(start, min(start + 8, len(grams)))
            best = min(window, key=lambda i: (h[i], -i))
            if (h[best], best) not in want:
                want.append((h[best], best))
        assert [(p.hash, p.position) for p in r.fingerprints] == want


def plain_characters(text, gram, window):
    m = (1 << 64) - 1
    numbers = [xxhash.xxh64_intdigest(c.encode(), 42) for c in text]
    if len(text) < gram:
        runs = [xxhash.xxh64_intdigest(text.encode(), 42) & 0xFFFFFFFF] if text else []
    else:
        turn = lambda x, by: (x << by | x >> (64 - by)) & m if by else x
        h, runs = 0, []
        for i, c in enumerate(numbers):  # rolling: turn, drop the character that leaves, take the one that enters
            h = turn(h, 1) ^ c ^ (turn(numbers[i - gram], gram % 64) if i >= gram else 0)
            if i >= gram - 1:
                runs.append(h & 0xFFFFFFFF)
    out = []
    for start in range(max(len(runs) - window + 1, 1) if runs else 0):
        best = min(range(start, min(start + window, len(runs))), key=lambda i: (runs[i], -i))
        if (runs[best], best) not in out:
            out.append((runs[best], best))
    return out


def unpacked(prints):
    return [(x >> 31, 2147483647 - (x & 2147483647)) for x in prints]


def sample_texts():
    rng = np.random.default_rng(1)
    return ["", "a", "aa" * 40, "日本語😀" * 9, " \t\n ", *("".join(rng.choice(list("ab c日"), n)) for n in (5, 15, 16, 17, 39, 40, 300))]


@pytest.mark.parametrize("gram,window", [(16, 24), (5, 4), (7, 1), (1, 3), (13, 8)])
def test_character_windows_equal_plain_rolling(spark, gram, window):
    frame = spark.createDataFrame([(t,) for t in sample_texts()], "t string")
    for r in winnowing.winnow_characters(frame, "t", "prints", gram, window).collect():
        assert unpacked(r.prints) == plain_characters(r.t, gram, window)


@pytest.mark.parametrize("gram,window", [(16, 24), (4, 5), (1, 3)])
def test_edited_prints_equal_the_edited_texts_own(spark, gram, window):
    rng = np.random.default_rng(4)
    texts = [*sample_texts(), *("".join(rng.choice(list("ab"), n)) for n in rng.integers(0, 130, 150)), "x" * 500, "y" * 3, "ab" * 90]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    rows = winnowing.with_edited(docs, rows_per_block=9, gram=gram, window=window).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text, after = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert r.edited == edited and unpacked(r.own) == plain_characters(text, gram, window)
        assert unpacked(r.next_prints) == plain_characters(after, gram, window)
        assert unpacked(r.edited_prints) == plain_characters(edited, gram, window)


def test_far_and_missing_ids_are_dealt_evenly(spark):
    ids = [2**62, -(2**62), *range(500), *[7] * 3000, *[None] * 20_000]
    docs = spark.createDataFrame([(i, f"text {n % 5000}", "en", "s", 0) for n, i in enumerate(ids)], DOCS).repartition(8)
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
    places = docs.select(place.alias("at"))
    blocks = places.withColumn("bounds", winnowing._bounds(places, 500).scalar()).groupBy(winnowing._block("at", "bounds").alias("block")).count()
    sizes = [r["count"] for r in blocks.collect()]
    assert sum(sizes) == len(ids) and max(sizes) < 1500 and len(sizes) > 35
    rows = winnowing.with_edited(docs, rows_per_block=500).collect()
    assert len(rows) == len(ids) and Counter(r.doc_id for r in rows) == Counter(ids)
    assert all(r.next_prints for r in rows)


def test_a_shifted_copy_is_found_without_spaces(spark):
    passage = "".join(np.random.default_rng(2).choice(list("日本語文字列検査用例"), 400))
    docs = spark.createDataFrame([(1, passage, "ja", "a", 0), (2, "新" + passage, "ja", "a", 0), (3, None, "ja", "a", 0)], DOCS)
    first, second, _ = sorted(winnowing.with_edited(docs).collect(), key=lambda r: r.doc_id)
    assert len({x >> 31 for x in first.own} & {x >> 31 for x in second.own}) > 0.8 * len(first.own)


def test_edited_texts(spark):
    docs = documents(spark)
    rows = {r.doc_id: r for r in winnowing.op8_fingerprints(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts)
    prints = defaultdict(set)
    for n, d in enumerate(order):
        text, after = texts[d], texts[order[(n + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = rows[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        prints[text].add(r.fingerprint)
    assert all(len(v) == 1 for v in prints.values())
    assert sum(rows[d].near_edited > rows[d].near_next for d in order) > 0.9 * len(order)


def test_edited_odd_rows(spark):
    docs = clashing(odd_documents(spark))
    rows = winnowing.with_edited(docs, rows_per_block=2).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[3].n_chars == 0 and by[3].edited == "" and by[3].own == []
    assert by[6].edited == "x"
    assert by[8].edited.endswith("a document without a number"[:20][-5:]) or by[8].edited
    alone = winnowing.with_edited(docs.where("doc_id = 1")).first()
    assert alone.edited[:30] == "The quick brown fox jumps over" and alone.edited[30:] == "The quick brown fox jumps over"[:30]
    assert winnowing.with_edited(docs.limit(0)).collect() == []


# tokens


def test_pieces_equal_the_library(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = documents(spark).unionByName(odd_documents(spark))
    for r, text in zip(pieces.encoded(clashing(docs).coalesce(1)).collect(), [r.text for r in docs.coalesce(1).collect()]):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded == library.decode(ids) and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert pieces.encoded(docs.limit(0)).collect() == []


def test_agenda_takes_the_leftmost_of_equal_scores():
    import public_tokenizers

    coder = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for text in ("aaaaaaa", "     ", "ababababab", "\n\n\n", "▁▁a", "a" * 3000, "\x00\x01"):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == coder.library.encode(text)
    coder.check()
    coder.fresh = {"ab": b"\x01\x00\x00\x00"}
    with pytest.raises(ValueError, match="differ"):
        coder.check()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library(spark, name):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    docs = documents(spark).limit(60).unionByName(odd_documents(spark))
    if name.endswith(".json"):
        library = Tokenizer.from_file(path)
        expected = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    else:
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        expected = lambda t: len(library.encode(t))
    want = Counter((r.doc_id, len((r.text or "").encode()), expected(r.text or "")) for r in docs.collect())
    got = counts.count_tokens(clashing(docs), path, scratch_path(spark, "cache")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_cache_encodes_misses_only(spark, monkeypatch):
    import public_tokenizers

    path, cache = public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "cache")
    docs = odd_documents(spark)
    version = counts.tokenizer_version(path)
    counts.count_tokens(docs, path, cache).collect()
    stored = counts.read_cache(spark, cache, version)
    assert stored.count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    more = docs.unionByName(spark.createDataFrame([(50, "new text", None, None, 8)], DOCS))
    before = stored.count()
    got = counts.count_tokens(more, path, cache).collect()
    assert counts.read_cache(spark, cache, version).count() == before + 1 and len(got) == more.count()
    assert counts.read_cache(spark, cache, "another").count() == 0
    assert counts.count_tokens(docs.limit(0), path, cache).collect() == []


# language scores


def test_language_scores_equal_plain_models(spark):
    docs = odd_documents(spark).where("doc_id is null or doc_id <> 7").unionByName(documents(spark).limit(10))
    target = documents(spark).limit(4)
    got = language.cross_entropy_difference(clashing(docs), target, size=900)
    texts = [r.text for r in docs.collect()]
    totals = Counter(w for t in texts for w in language.words_of(t))
    by_count = Counter(totals.values())
    room, least = 900, max(by_count) + 1
    for n in sorted(by_count, reverse=True):
        room -= by_count[n]
        if room < 0:
            break
        least = n
    known = {w for w, n in totals.items() if n >= least}
    cut = lambda t: [w if w in known else None for w in language.words_of(t)]
    size = len(known) + 2

    def model(all_texts):
        single, first, pairs = Counter(), Counter(), Counter()
        for t in all_texts:
            words = cut(t)
            single.update(words)
            for a, b in zip(["<s>", *words], words):
                first[a] += 1
                pairs[a, b] += 1
        total = sum(single.values())

        def loss(words):
            out = []
            for a, b in zip(["<s>", *words], words):
                own = (single[b] + 1) / (total + size)
                weight = 0.6 if first[a] else 0.0
                out.append(-math.log(weight * pairs[a, b] / max(first[a], 1) + (1 - weight) * own))
            return sum(out) / len(out) if out else 0.0

        return loss

    near, far = model([r.text for r in target.collect()]), model(texts)
    want = sorted(round(near(cut(t)) - far(cut(t)), 9) for t in texts)
    assert want == sorted(round(r.score, 9) for r in got.collect())
    assert language.cross_entropy_difference(docs.limit(0), target).collect() == []
    assert all(r.score >= 0 or r.n_words for r in language.cross_entropy_difference(docs, target.limit(0)).collect())


def test_word_classes_fill_their_cells():
    assert language.word_classes(30, 1024).tolist() == list(range(30))
    classes = language.word_classes(5000, 1024)
    assert classes[:24].tolist() == list(range(24)) and set(classes.tolist()) == set(range(32))
    sizes = np.bincount(classes)[24:]
    assert sizes.max() - sizes.min() <= 1


def test_probabilities_sum_to_one_with_shared_classes():
    rng = np.random.default_rng(5)
    classes = language.word_classes(300, 400)
    shape = language.Shape({}, classes, 0.6)
    single, first, pairs = np.zeros(300, int), np.zeros(shape.n_classes, int), np.zeros(shape.n_classes**2, int)
    for _ in range(40):
        ids = rng.zipf(1.3, 50) % 298 + 2
        before, cells = shape.class_pairs(ids)
        np.add.at(single, ids, 1)
        np.add.at(first, before, 1)
        np.add.at(pairs, cells, 1)
    model = language.estimates(shape, (single, first, pairs))
    for before in (2, 3, 17, 120, 299):
        sums = sum(math.exp(-language.losses(shape, model, np.array([before, word]))[1]) for word in range(300))
        assert abs(sums - 1) < 1e-9


def plain_losses(texts, size):
    """Mean losses per text by a model of all words and pairs of ``texts``."""
    single, first, pairs = Counter(), Counter(), Counter()
    for t in texts:
        words = language.words_of(t)
        single.update(words)
        first.update(["<s> ", *words][: len(words)])
        pairs.update(zip(["<s> ", *words], words))

    def loss(text):
        words, out = language.words_of(text), []
        for a, b in zip(["<s> ", *words], words):
            weight = 0.6 if first[a] else 0.0
            out.append(-math.log(weight * pairs[a, b] / max(first[a], 1) + (1 - weight) * (single[b] + 1) / (single.total() + size)))
        return sum(out) / len(out) if out else 0.0

    return loss


def test_every_word_has_its_own_count(spark):
    """More words than the 32 768 of the bounded vocabulary; rare ones tell target from background."""
    rows = [(n, " ".join(f"w{n}x{i}" for i in range(400)), "en", "a", 0) for n in range(100)]
    rows += [(100, rows[0][1], "en", "a", 0), (101, rows[99][1], "en", "a", 0), (None, None, "en", "a", 0), (102, " ", "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    target = spark.createDataFrame(rows[:1], DOCS)
    near, far = plain_losses([rows[0][1]], 40_002), plain_losses([r[1] for r in rows], 40_002)
    got = {r.doc_id: r for r in language.cross_entropy_difference(docs, target).collect()}
    assert len(got) == len(rows)
    for key, text, *_ in rows:
        assert abs(got[key].target_loss - near(text)) < 1e-9 and abs(got[key].background_loss - far(text)) < 1e-9
    assert got[100].score < got[101].score - 1
    labelled = {r.doc_id: r for r in language.scores_by_keys(docs, docs.select("doc_id").where("doc_id = 0 or doc_id is null")).collect()}
    assert all(abs(labelled[k].score - got[k].score) < 1e-9 and labelled[k].n_words == got[k].n_words for k in got)


def test_pairs_are_of_words_at_every_size(spark):
    """2000 words, all in pairs of their own; words that once shared a class tell which follows which."""
    rng = np.random.default_rng(3)
    follower = rng.permutation(2000)
    texts = [" ".join(f"v{i} v{follower[i]}" for i in rng.integers(0, 2000, 300)) for _ in range(40)]
    docs = spark.createDataFrame([(n, t, "en", "a", 0) for n, t in enumerate(texts)], DOCS)
    size = len({w for t in texts for w in t.split()}) + 2
    far = plain_losses(texts, size)
    for bound in (None, size):
        got = language.cross_entropy_difference(docs, docs.where("doc_id < 5"), size=bound).collect()
        assert all(abs(r.background_loss - far(texts[r.doc_id])) < 1e-9 for r in got)


# quality


def test_quality_separates_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = quality.quality_scores(docs.join(labels.where(quality.held_out()), "doc_id"), model).collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    wins = sum((g.score > b.score) + 0.5 * (g.score == b.score) for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.93 and sum(r.predicted for r in good) > 0.97 * len(good)


def test_labels_learned_from_are_not_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, labels) == quality.train(docs, flipped)
    got = quality.op10_quality(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_quality_of_odd_rows(spark):
    docs = clashing(odd_documents(spark))
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (2, None, 1), (None, 1, 0), (8, 7, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0), labels.where("quality = 1")):
        rows = quality.quality_scores(docs, quality.train(docs, some)).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality.quality_scores(docs.limit(0), quality.train(docs.limit(0), labels)).collect() == []


def test_long_texts_are_learned_from(spark):
    """Only texts over 32 000 bytes are labelled."""
    word = {1: "forest river mountain valley meadow", 0: "click buy cheap win prize"}
    rows = [(i, " ".join(f"{w}{(i * 7 + j) % 91}" for j in range(1000) for w in word[i % 2].split()), i % 2) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    assert min(len(r[1]) for r in rows) > 32_000
    model = quality.train(frame.select("doc_id", "text"), frame.select("doc_id", "quality"))
    held = quality.quality_scores(frame, model).where(quality.held_out()).collect()
    assert held and all(r.predicted == r.quality for r in held)


def test_sample_is_bounded_by_bytes_and_its_texts_by_order(spark, monkeypatch):
    rows = [(i, f"{'good' if i % 2 else 'poor'} text {i} " * 50) for i in range(300)]
    docs, again = (spark.createDataFrame(rows + extra, "doc_id long, text string") for extra in ([], [(i, "zzz " * 99) for i, _ in rows]))
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    assert quality.train(docs, labels) == quality.train(again, labels) == quality.train(again.repartition(7), labels)  # the least text counts
    whole = quality.train(docs, labels)
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 5000)
    small = quality.train(docs, labels)
    assert 0 < len(small.good) < 5000 + 1000 and small != whole


def test_calibration_rises():
    xs, ys = quality.calibrate(np.array([-0.1, -0.1, 0.0, 0.05, 0.05, 0.1]), np.array([0.0, 0, 1, 0, 1, 1]))
    assert list(xs) == sorted(set(xs)) and list(ys) == sorted(ys)
    assert quality.calibrate(np.array([]), np.array([]))[1] == (0.5, 0.5)
