from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from geoledger.functions.codes import department_of, level_for_zoom, score_text, sentiment, truncate_text, url_class
from geoledger.functions.text import canonical, is_derived, normalize_text
from geoledger.operators import reviews as R
from geoledger.operators import words as T
from geoledger.sources import bindings as B

REVIEW = "review_id string, city_id string, score double, description string"


def _column(rows, values, kind, expr):
    found = rows([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(expr(F.col("v")))
    return [r[0] for r in found.collect()]


def test_normalize(rows):
    texts = ["L'École, n°2 !", "  a\tb  c ", None, "œuvre—été", "123"]
    assert _column(rows, texts, "string", normalize_text) == ["l école n", "a\tb c", "", "œuvre été", ""]


def test_sentiment_classes(rows):
    found = _column(rows, [4.0, 3.9, 2.1, 2.0, None], "double", sentiment)
    assert found == ["positive", "neutral", "neutral", "negative", "negative"]


def test_department_codes(rows):
    found = _column(rows, ["01053", "2A004", "97105", "", "7", "97"], "string", department_of)
    assert found == ["01", "2A", "971", "", "", "97"]


def test_url_classes(rows):
    base = "https://reviews.example/"
    urls = ["town-01053/avis.html", "town-01053/quartier-3/avis.html", "Arrondissement/avis.html", "town-2A004/avis.html"]
    assert _column(rows, [base + u for u in urls], "string", url_class) == ["valid", "quarter", "district", "other"]


def test_levels(rows):
    found = _column(rows, list(range(1, 16)), "int", level_for_zoom)
    assert found == ["region"] * 6 + ["department"] * 3 + ["city"] * 6


def test_texts(rows):
    assert _column(rows, ["4.2/5", "x/5", None], "string", score_text) == [4.2, 0.0, 0.0]
    assert _column(rows, ["a" * 100, "a" * 101], "string", truncate_text) == ["a" * 100, "a" * 97 + "..."]


def test_derived_and_canonical(rows):
    assert _column(rows, ["voiture", "vin", "viens", "maison"], "string", is_derived) == [True, False, False, False]
    assert _column(rows, ["communes", "lycér", "scolaire", "parc"], "string", canonical) == ["commune", "lycée", "école", "parc"]


def test_word_rules(spark, rows):
    lexicon = B.lexicon(spark)
    reviews = rows(
        [("1", "c", 5.0, "Les communes, la voiture ; le LYCÉES au parc"), ("2", "c", 1.0, "Parc vie mange ab"), ("3", "c", 3.0, "ok")],
        REVIEW,
    )
    counts = {r["word"]: r["weight"] for r in T.city_word_counts(reviews, lexicon).collect()}
    assert counts == {"commune": 1, "lycée": 1, "parc": 2}


def test_counting_before_the_lexicon_equals_counting_after(spark):
    reviews, lexicon = B.reviews(spark, "/root/testdata/sf0.001"), B.lexicon(spark)
    late = T.significant(T.tokens(reviews, lexicon)).groupBy("city_id", "word").agg(F.count("*").alias("weight"))
    early = T.city_word_counts(reviews, lexicon)
    assert late.exceptAll(early).count() == 0 and early.exceptAll(late.select(early.columns)).count() == 0


def test_top_words_order(rows):
    counts = rows([("c", "b", 2), ("c", "a", 2), ("c", "z", 9), ("c", "y", 1)], "city_id string, word string, weight bigint")
    ranked = T.top_words(counts, ["city_id"], 3)
    lists = T.word_lists(ranked, ["city_id"]).collect()[0]["words"]
    assert [(w["word"], w["weight"]) for w in lists] == [("z", 9), ("a", 2), ("b", 2)]


def test_sentiment_percents(rows):
    reviews = rows([(str(i), "c", 4.5 if i < 19 else 3.0, "") for i in range(21)], REVIEW)
    row = T.city_sentiment(reviews).collect()[0]
    assert (row["positive_percent"], row["neutral_percent"], row["negative_percent"]) == (90.5, 9.5, 0.0)


DOCS = "city_id string, city_name string, words array<struct<word:string,weight:bigint>>, sentiment struct<positive:bigint,neutral:bigint,negative:bigint,positive_percent:double,neutral_percent:double,negative_percent:double>"


def test_word_map_and_series(rows):
    docs = rows([("1", "one", [("test", 5), ("example", 3)], (50, 30, 20, 50.0, 30.0, 20.0)), ("2", "two", [], (0, 0, 0, 0.0, 0.0, 0.0))], DOCS)
    maps = {r["city_id"]: r["word_frequencies"] for r in T.word_frequencies(docs).collect()}
    assert maps == {"1": {"test": 5, "example": 3}, "2": {}}
    series = T.sentiment_series(docs.where("city_id = '1'")).orderBy("position").collect()
    assert [(r["label"], r["value"], r["colour"]) for r in series] == [
        ("Positif", 50, "green"), ("Neutre", 30, "gray"), ("Négatif", 20, "red"),
    ]
    broken = rows([("1", "one", [], (1, None, 2, 0.0, 0.0, 0.0))], DOCS)
    with pytest.raises(Exception, match="sentiment class missing"):
        T.sentiment_series(broken).collect()


def test_region_scores(rows):
    docs = rows([("r", 2, (3.0,)), ("r", 1, (4.0,))], "region_id string, cities bigint, s struct<mean:double>")
    wide = docs.select("region_id", "cities", F.struct(*[F.col("s.mean").alias(n) for n in ("mean", "safety", "education", "sport_leisure", "environment", "practical_life")]).alias("scores"))
    assert R.region_scores(wide).collect()[0]["mean"] == 3.3


def test_details_are_all_or_nothing(spark, rows):
    cities = B.city_documents(spark, "/root/testdata/sf0.001")
    docs = rows([("1", "one", [("parc", 2)], (1, 0, 0, 100.0, 0.0, 0.0))], DOCS)
    ids = rows([("1",), ("2",), ("nowhere",)], "city_id string")
    found = {r["city_id"]: r for r in R.city_details(ids, cities, docs).collect()}
    assert found["1"]["word_frequencies"] == {"parc": 2} and found["1"]["review_count"] > 0
    for name in ("2", "nowhere"):
        assert found[name]["review_count"] == 0 and found[name]["word_frequencies"] == {}
        assert found[name]["grades"]["safety"] == 0.0 and found[name]["sentiment"]["positive"] == 0


def test_unknown_department_gets_a_label(rows):
    df = rows([("99", 1)], "department_id string, n int")
    areas = rows([("01", "Ain", "84")], "department_id string, name string, region_id string")
    row = R.with_area_names(df, areas, "department_id", "Département ").collect()[0]
    assert (row["name"], row["region_id"]) == ("Département 99", "")


def test_tasks_hold_a_bounded_piece_of_the_texts(spark, rows, monkeypatch):
    """Tokens are counted per review in pieces of bounded size, also where ids repeat or lack."""
    monkeypatch.setattr(T, "PIECE_BYTES", 200)
    texts = [(None if i % 50 == 0 else str(i % 300), "c", 1.0, f"le parc mot{i % 3} les communes") for i in range(600)] + [("x", "c", 1.0, None)]
    reviews, lexicon = rows(texts, REVIEW), B.lexicon(spark)
    pieces = T.in_pieces(reviews)
    assert pieces.rdd.getNumPartitions() == -(-sum(len(t[3] or "") for t in texts) // 200)
    counted = lambda df: df.groupBy("review_id", "token", "lemma", "pos", "is_stop").count()
    got, want = counted(T.tokens(pieces, lexicon)), counted(T.tokens(reviews, lexicon))
    plan = got._jdf.queryExecution().executedPlan().toString()  # of the shuffles only the one by id is left
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
