from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from geoledger.operators import pages as H
from geoledger.operators import quality as V
from geoledger.operators import rankings as K
from geoledger.operators import words as T
from geoledger.sources import bindings as B
from geoledger.sources import files as S
from geoledger.streaming import incremental
from geoledger.streaming.incremental import documents, process_batch, run_incremental

PAGE = """<html><head><script>var x = '<h1>no</h1>';</script></head><body><!-- <h1>comment</h1> -->
<h1> Bourg <small>01000</small></h1><div class="total">3.5/5</div><div class="nbtotal">Note sur 12 commentaires</div>
<table class="bloc_chiffre"><tr><td>Sécurité<br></td><td><span>4.1</span></td></tr>
<tr><td>Sports et loisirs</td><td><span>n/a</span></td></tr><tr><td>Vie pratique</td><td><span> 2 </span></td></tr></table>
<div class="commentaire" data-pouce="77"><div class="auteur"> Ana </div><span class="note_total">4.5</span>
<div class="notes"><span>1</span><span>2</span><span>3</span></div><div class="date">03/02/2024</div>
<p class="description">Très bien &amp; calme</p><div class="pouce" data-pouce="1"><span>5</span></div>
<div class="pouce" data-pouce="0"><span>2</span></div></div>
<div class="commentaire reponse"><p class="description">answer</p></div><div class="bdmv commentaire"></div>
<div class="commentaire" data-pouce="78"><span class="note_total">bad</span></div>
<div class="commentaire" data-pouce="79"></div></body></html>"""


def test_page_extraction(rows):
    pages = rows(
        [("https://reviews.example/bourg-01053/avis.html", PAGE), ("https://reviews.example/x-97105/avis.html?page=2", "<p>nothing"), ("u", None)],
        "url string, html string",
    )
    cities, reviews = H.extract_pages(pages)
    (city,) = cities.collect()
    assert (city["city_id"], city["department_id"], city["name"], city["postal_code"]) == ("01053", "01", "Bourg 01000", "01000")
    assert city["review_count"] == 12 and city["status"] == "unprocessed"
    assert city["scores"].asDict() == {
        "mean": 3.5, "safety": 4.1, "education": 0.0, "sport_leisure": 0.0, "environment": 0.0, "practical_life": 2.0,
    }
    found = {r["review_id"]: r for r in reviews.collect()}
    assert set(found) == {"77", "79"}
    first, last = found["77"], found["79"]
    assert (first["author"], first["score"], first["description"]) == ("Ana", 4.5, "Très bien & calme")
    assert (first["thumbs_up"], first["thumbs_down"], first["review_day"]) == (5, 2, datetime.date(2024, 2, 3))
    assert first["scores"].asDict() == {
        "safety": 1.0, "education": 2.0, "sport_leisure": 3.0, "environment": 0.0, "practical_life": 0.0,
    }
    assert (last["author"], last["score"], last["review_date"], last["description"]) == ("Anonyme", 0.0, "", "")


REVIEW = "review_id string, city_id string, score double, description string"
STATE = "city_id string, name string, status string, processed_at timestamp"


def _run(spark, tmp_path, cities, buckets=4):
    stream = spark.readStream.schema(REVIEW).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    return run_incremental(stream, str(tmp_path / "state"), str(tmp_path / "checkpoint"), B.lexicon(spark), cities, buckets)


def test_incremental_equals_batch_and_repeats_change_nothing(spark, rows, tmp_path):
    batches = [
        [("1", "a", 5.0, "parc calme"), ("2", "b", 1.0, "bruit")],
        [("3", "a", 3.0, "parc école"), ("1", "a", 1.0, "parc triste")],
        [("4", "c", 4.0, "marché"), ("5", "b", None, "bruit route")],
    ]

    cities = rows([("a", "A", None, None), ("b", "B", "unprocessed", None), ("c", "C", "processed", None), ("d", "D", None, None)], STATE)
    sink = str(tmp_path / "state")

    def state(docs):
        return {r["city_id"]: (r["city_name"], r["words"], r["sentiment"]) for r in docs.collect()}

    seen: dict[tuple, tuple] = {}
    for i, batch in enumerate(batches):
        rows(batch, REVIEW).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{i}"))
        docs, flagged = _run(spark, tmp_path, cities)
        seen |= {row[:2]: row for row in batch}
        expected = T.city_word_documents(cities, rows(list(seen.values()), REVIEW), B.lexicon(spark))
        assert state(docs) == state(expected)
    marks = {r["city_id"]: (r["status"], r["processed_at"] is not None) for r in flagged.collect()}
    assert marks == {"a": ("processed", True), "b": ("processed", True), "c": ("processed", False), "d": ("processed", True)}
    before = state(docs)
    assert state(_run(spark, tmp_path, cities)[0]) == before
    last = rows(batches[-1], REVIEW)
    process_batch(last, len(batches) - 1, sink, B.lexicon(spark), 4)  # replayed
    assert state(documents(spark, sink, cities)) == before
    (tmp_path / "state" / "reviews" / "batch=0").rename(tmp_path / "texts of the first batch")
    process_batch(rows([("1", "a", 5.0, "mairie mairie")], REVIEW), len(batches), sink, B.lexicon(spark), 4)  # reads no earlier text
    words = state(documents(spark, sink, cities))["a"][1]
    assert [tuple(w) for w in words] == [("mairie", 2), ("parc", 1), ("école", 1)]
    process_batch(last.limit(0), len(batches) + 1, sink, B.lexicon(spark), 4)
    assert [tuple(w) for w in state(documents(spark, sink, cities))["a"][1]] == [tuple(w) for w in words]


def test_state_stays_bounded_and_merging_batches_can_be_replayed(spark, rows, tmp_path):
    sink, lexicon = str(tmp_path / "state"), B.lexicon(spark)
    cities = rows([(c, c.upper(), None, None) for c in "abc"], STATE)
    spark.createDataFrame([], incremental.STATE).write.parquet(f"{sink}/done/batch=-1")
    seen: dict[str, tuple] = {}

    def state():
        return {r["city_id"]: (sorted(map(tuple, r["words"])), r["sentiment"]) for r in documents(spark, sink, cities).collect()}

    def read_next():
        """Folders and bytes of the items that the next batch reads."""
        found = [r for r in incremental._state(spark, sink)[1] if r["name"] in ("items", "merged")]
        files = [f for r in found for f in (tmp_path / "state" / r["name"] / f"batch={r['folder']}" / f"bucket={r['bucket']}").glob("*.parquet")]
        return len(found), sum(f.stat().st_size for f in files)

    measured = {}
    for i in range(9):
        # the same three reviews every time, one of them now and then in another city
        batch = [("1", "ab"[i // 2 % 2], float(i % 6), f"parc mot{i}"), ("2", "b", 1.0, "bruit"), ("3", "c", None, f"école x{i}")]
        process_batch(rows(batch, REVIEW), i, sink, lexicon, 1, merge_after=3)
        if i in (2, 5):  # the batch after has three folders to merge
            process_batch(rows(batch, REVIEW), i, sink, lexicon, 1, merge_after=3)
        seen |= {row[0]: row for row in batch}
        expected = T.city_word_documents(cities, rows(list(seen.values()), REVIEW), lexicon)
        assert state() == {r["city_id"]: (sorted(map(tuple, r["words"])), r["sentiment"]) for r in expected.collect()}
        if i in (3, 6):  # merging batches, replayed
            before = state(), read_next()
            process_batch(rows(batch, REVIEW), i, sink, lexicon, 1, merge_after=3)
            assert (state(), read_next()[0]) == (before[0], before[1][0])
        measured[i] = read_next()
    assert [measured[i][0] for i in range(9)] == [1, 2, 3, 1, 2, 3, 1, 2, 3]
    assert abs(measured[8][1] - measured[5][1]) < 0.05 * measured[5][1]
    assert len(list((tmp_path / "state" / "done").glob("batch=*"))) == 2


def test_sample_is_repeatable_and_bounded(spark):
    sf = "/root/testdata/sf0.001"
    cities, reviews = B.city_documents(spark, sf), B.reviews(spark, sf)
    one, two = K.review_sample(cities, reviews, 1), K.review_sample(cities, reviews.repartition(5), 1)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    per_city = one.groupBy("city_id").count().collect()
    assert len(per_city) == 5 and max(r["count"] for r in per_city) <= 3


def test_histogram(rows):
    df = rows([(float(v),) for v in (0, 1, 2, 3, 4, 10)] + [(None,)], "v double")
    found = K.histogram(df, "v", 5).orderBy("bucket").collect()
    assert [r["n"] for r in found] == [2, 2, 1, 0, 1]
    flat = K.histogram(rows([(3.0,), (3.0,)], "v double"), "v", 2).orderBy("bucket").collect()
    assert [(r["low"], r["n"]) for r in flat] == [(2.5, 0), (3.0, 2)]


def test_missing_fields_and_presence(rows):
    df = rows([("a", None, (1.0,)), (None, None, (None,))], "x string, y string, s struct<m:double>")
    found = {r["field"]: r["missing"] for r in V.missing_fields(df, ["x", "y", "s.m", "s.k", "gone"]).collect()}
    assert found == {"x": 1, "y": 2, "s.m": 1, "s.k": 2, "gone": 2}
    assert [r["present"] for r in V.require_nonempty({"t": df}).collect()] == [True]
    with pytest.raises(Exception, match="empty input: none"):
        V.require_nonempty({"none": df.limit(0)}, strict=True).collect()


def test_profile_example(rows):
    found = V.profile({"t": rows([("a", 1)], "x string, y int")}, None).collect()
    assert [(r["column"], r["type"], r["rows"], r["example"]) for r in found] == [
        ("x", "string", 1, '{"x":"a","y":1}'), ("y", "int", 1, '{"x":"a","y":1}'),
    ]


def test_write_table_and_find(spark, rows, tmp_path):
    df = rows([("b", 2), ("a", 1)], "id string, n int")
    S.write_table(df, str(tmp_path / "t"), partitions=2)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert S.find_one(stored, F.col("n") > 0, ["id"]).collect()[0]["id"] == "a"
    assert S.find(stored, F.col("n") > 1, ["id"]).collect()[0]["id"] == "b"


def test_stored_rollups_have_no_mismatch(spark):
    from geoledger.plans import inputs as I

    sf = "/root/testdata/sf0.001"
    stats = I.all_stats(spark, sf)
    assert V.rollup_mismatches(stats["city"], stats["department"], "department").count() == 0
    assert V.rollup_mismatches(stats["department"], stats["region"], "region").count() == 0
    departments = I.stored_department_docs(spark, sf)
    regions = I.region_docs(spark, sf, departments)
    assert all(r["ok"] for r in V.score_checks(departments, regions).collect())
    checks = {r["check"]: r["ok"] for r in V.review_rollup_check(B.city_documents(spark, sf), departments, regions).collect()}
    assert checks["reviews_city_department"] and checks["reviews_department_region"] and checks["cities_department_region"]
