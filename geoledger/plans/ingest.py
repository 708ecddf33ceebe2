"""Registered queries on sources, sinks, upserts, state and page extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions import geometry as G
from geoledger.functions.codes import city_code, department_of, review_count, score_text, truncate_text
from geoledger.operators import imports as J
from geoledger.operators import pages as H
from geoledger.operators import transactions as P
from geoledger.operators import upsert as U
from geoledger.operators import words as T
from geoledger.plans import inputs as I
from geoledger.schemas import TRANSACTION_HEADER
from geoledger.sources import bindings as B
from geoledger.sources import files as S
from geoledger.sources.scratch import remove_path, scratch_path
from geoledger.streaming.incremental import run_incremental

ORDER = ["tx_date", "price", "city_id", "built_area", "land_area", "lon", "lat"]
KEYS = ["tx_id", "parcel_id"]
LABELS = {
    "safety": "Sécurité", "education": "Éducation", "sport_leisure": "Sport et loisirs", "environment": "Environnement",
    "practical_life": "Vie pratique",
}
PIECE = 100_000  # records of a compressed CSV file, which one task reads
REVIEW_FILES = "review_id string, city_id string, score double, description string, delivery int"


# --- sources ------------------------------------------------------------------------------------


def _write_csv(tx: DataFrame) -> str:
    """Transactions as CSV with quotes, line breaks and leading zeros, in files of two kinds: a quarter of the rows in plain ones, the
    others in compressed pieces whose columns stand in another order."""
    path = scratch_path(tx.sparkSession, "transactions-csv")
    tx = tx.withColumns(
        {
            "postal_code": F.lpad("city_id", 5, "0"),
            "city_name": F.concat(F.lit('Town "'), "city_id", F.lit('"\nwith, comma')),
        }
    )
    out = tx.select(*[F.col(name).alias(header) for header, name in TRANSACTION_HEADER.items()])
    pieces = {"compression": "gzip", "maxRecordsPerFile": PIECE}
    plain = F.pmod(F.xxhash64(*out.columns), F.lit(4)) == 0
    for part, columns, how in ((plain, out.columns, {}), (~plain, out.columns[::-1], pieces)):
        some = out.where(part).select(*columns)
        some.write.mode("append").options(header=True, escape='"', quoteAll=True, **how).csv(path)
    return path


def s1_transaction_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The files read back by header name."""
    return P.conform_transactions(S.read_transactions_csv(spark, _write_csv(B.transactions(spark, sf))))


def s1_import_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the sales imported first, then all of them at other prices: stored sales stay.  Files that were imported are deleted."""
    tx = B.transactions(spark, sf)
    first, second = scratch_path(spark, "import"), scratch_path(spark, "import")
    half = _write_csv(tx.where(F.col("tx_id").cast("bigint") % 2 == 0))
    J.import_transactions(spark, half, first)
    remove_path(spark, half)
    whole = _write_csv(tx.withColumn("price", F.col("price") + 1))
    stored = J.import_transactions(spark, whole, second, previous=first)
    remove_path(spark, whole)
    return stored.select("tx_id", "parcel_id", "tx_date", "price", "city_id", "built_area", "land_area", "lon", "lat")


def _write_geojson(spark: SparkSession, areas: DataFrame, level: str, chunk: int = 500) -> str:
    """FeatureCollections of at most ``chunk`` areas, one per line."""
    key = f"{level}_id"
    number = F.col(key).cast("bigint")
    nested = G.coordinates_json("geometry")
    single = (number % 2 == 0) & (F.size("geometry") == 1)
    kind = F.when(single, "Polygon").otherwise("MultiPolygon")
    text = F.when(single, F.expr("substring(_nested, 2, length(_nested) - 2)")).otherwise(F.col("_nested"))
    quoted = F.when(number % 3 == 0, F.regexp_replace(text, r"\[(-?[0-9.]+,-?[0-9.]+)\]", '"[$1]"')).otherwise(text)
    names = {"code": key, "nom": "name", "departement": "department_id", "region": "region_id"}
    properties = F.struct(*[F.col(c).alias(n) for n, c in names.items() if c in areas.columns])
    feature = F.concat(
        F.lit('{"type":"Feature","properties":'), F.to_json(properties), F.lit(',"geometry":{"type":"'), kind,
        F.lit('","coordinates":'), quoted, F.lit("}}"),
    )
    lines = (
        areas.withColumn("_nested", nested)
        .groupBy(F.floor(number / chunk).alias("chunk"))
        .agg(F.array_join(F.collect_list(feature), ",").alias("features"))
        .select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "features", F.lit("]}")).alias("value"))
    )
    path = scratch_path(spark, f"{level}-geojson")
    lines.write.text(path)
    return path


def _areas_read(spark: SparkSession, areas: DataFrame, level: str) -> DataFrame:
    read = S.read_areas_geojson(spark, _write_geojson(spark, areas, level), level)
    return read.withColumn("polygons", F.size("geometry")).drop("geometry")


def s2_city_geojson(spark: SparkSession, sf: str) -> DataFrame:
    return _areas_read(spark, B.cities(spark, sf), "city")


def s2_department_geojson(spark: SparkSession, sf: str) -> DataFrame:
    return _areas_read(spark, B.department_areas(spark, sf), "department")


def s2_region_geojson(spark: SparkSession, sf: str) -> DataFrame:
    return _areas_read(spark, B.region_areas(spark, sf), "region")


def s2_import_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Some cities imported first, then others under another name: known areas keep their name, new ones enter whole.

    The outline of every seventh city crosses itself."""
    number = F.col("department_id").cast("int")
    ring = "geometry[0][0]"
    twisted = f"array(array(array({ring}[0], {ring}[2], {ring}[1], {ring}[3], {ring}[0])))"
    cities = B.cities(spark, sf).withColumn("geometry", F.expr(f"if(bigint(city_id) % 7 = 0, {twisted}, geometry)"))
    areas = {"city": cities.where(number < 15), "department": B.department_areas(spark, sf), "region": B.region_areas(spark, sf)}
    first, second = scratch_path(spark, "areas"), scratch_path(spark, "areas")
    J.import_areas(spark, {level: _write_geojson(spark, df, level) for level, df in areas.items()}, first)
    renamed = {level: df.withColumn("name", F.lit("renamed")) for level, df in (areas | {"city": cities.where(number >= 5)}).items()}
    stored = J.import_areas(spark, {level: _write_geojson(spark, df, level) for level, df in renamed.items()}, second, previous=first)
    parts = [
        df.select(
            F.lit(level).alias("level"), F.col(f"{level}_id").alias("id"), "name", "min_x", "min_y", "max_x", "max_y",
            F.size("geometry").alias("polygons"), "repaired",
        )
        for level, df in stored.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def s3_write_table(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated transactions staged as a table in two loads, written by year and read back, counted per year."""
    path, staged = scratch_path(spark, "transactions"), scratch_path(spark, "staged")
    first = U.dedup_insert(B.transactions(spark, sf), None, KEYS, ORDER)
    early = F.coalesce(F.col("tx_date") < "1995-01-01", F.lit(False))
    S.write_table(first.where(early), staged, partitions=4)
    S.write_table(first.where(~early), staged, mode="append", partitions=4)
    S.write_transactions(spark.read.parquet(staged), path)
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n"))


def s4_write_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Boundary table with some rows lacking geometry: those are skipped."""
    path = scratch_path(spark, "areas")
    missing = F.col("region_id") == "4"
    S.write_areas(B.cities(spark, sf).withColumn("geometry", F.when(~missing, F.col("geometry"))), path)
    return spark.read.parquet(path).select("city_id", "name", "min_x", "min_y", "max_x", "max_y")


def s5_find(spark: SparkSession, sf: str) -> DataFrame:
    return S.find(B.city_documents(spark, sf), F.col("review_count") > 0, ["city_id", "name", "review_count"])


def s6_find_one(spark: SparkSession, sf: str) -> DataFrame:
    return S.find_one(B.city_documents(spark, sf), F.col("review_count") > 0, ["city_id", "name"], "city_id")


def s7_document_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Nested city words written as JSON and read with a declared schema."""
    from geoledger.schemas import CITY_WORD_DOCUMENTS

    path = scratch_path(spark, "city-words-json")
    S.write_docs(I.city_word_docs(spark, sf), path)
    return T.exploded_words(S.read_docs(spark, path, CITY_WORD_DOCUMENTS), "city_id")


def s8_csv_export(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ranking-csv")
    S.export_csv(T.national_words(I.city_word_docs(spark, sf), C.AREA_WORDS), path)
    return spark.read.schema("word string, weight bigint").option("header", True).csv(path)


# --- upserts and state --------------------------------------------------------------------------


def u1_dedup_insert(spark: SparkSession, sf: str) -> DataFrame:
    """Stored early sales win over the same keys in the new file."""
    tx = B.transactions(spark, sf)
    early = U.first_per_key(tx.where(F.col("tx_date") < "1996-01-01"), KEYS, ORDER)
    return U.dedup_insert(tx, early.withColumn("price", F.lit(-1.0)), KEYS, ORDER)


def u2_upsert_geometry(spark: SparkSession, sf: str) -> DataFrame:
    cities = B.cities(spark, sf).select("city_id", "name", "department_id", "min_x", "min_y")
    stored = cities.where(F.col("department_id").cast("int") < 15)
    new = cities.where(F.col("department_id").cast("int") >= 5).withColumns(
        {"name": F.lit("renamed"), "min_x": F.col("min_x") + 0.5}
    )
    return U.upsert_columns(new, stored, ["city_id"], ["min_x", "min_y"])


def u3_upsert_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = I.city_stats(spark, sf).select("city_id", "region_id", "transactions", "price_mean")
    stale = stats.withColumn("price_mean", F.lit(0.0))
    return U.upsert_replace(stats.where(F.col("region_id") == "1"), stale, ["city_id"])


def u4_upsert_documents(spark: SparkSession, sf: str) -> DataFrame:
    stored = B.city_documents(spark, sf).select("city_id", "name", "status")
    counted = B.reviews(spark, sf).groupBy("city_id").agg(F.count(F.lit(1)).alias("reviews"))
    return U.upsert_merge(counted.withColumn("status", F.lit("unprocessed")), stored, ["city_id"])


def u5_unprocessed(spark: SparkSession, sf: str) -> DataFrame:
    return U.unprocessed(B.city_documents(spark, sf)).select("city_id", "name", "status")


def u6_mark_processed(spark: SparkSession, sf: str) -> DataFrame:
    cities = B.city_documents(spark, sf).select("city_id", "status", "processed_at")
    when = F.lit("2024-06-01 12:00:00").cast("timestamp")
    marked = U.mark_processed(cities, U.unprocessed(cities), when)
    return marked.withColumn("processed_at", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss"))


def _stored_pages(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """City pages, some of them quarters stored under the id of their city, and reviews with the page they stand on."""
    cities = B.city_documents(spark, sf)
    quarter = F.concat(F.lit("https://reviews.example/town-"), "city_id", F.lit("/quartier-"), "city_id", F.lit("/avis.html"))
    shared = F.col("city_id").try_cast("bigint") % 8 == 0
    pages = cities.unionByName(cities.where(shared).withColumn("url", quarter))
    on_quarter = shared & (F.col("review_id").cast("bigint") % 3 == 0)
    reviews = B.reviews(spark, sf).join(cities.select("city_id", "url"), "city_id", "left")
    return pages, reviews.withColumn("url", F.when(on_quarter & F.col("url").isNotNull(), quarter).otherwise(F.col("url")))


def u7_purge_counts(spark: SparkSession, sf: str) -> DataFrame:
    return U.purge_invalid(*_stored_pages(spark, sf))


def u7_purge_rest(spark: SparkSession, sf: str) -> DataFrame:
    """What remains after the purge."""
    cities, reviews = U.purge_invalid(*_stored_pages(spark, sf), dry_run=False)
    left = cities.select(F.lit("city").alias("kind"), F.col("url").alias("id"))
    return left.unionByName(reviews.select(F.lit("review").alias("kind"), F.col("review_id").alias("id")))


def _stored_urls(spark: SparkSession, sf: str) -> DataFrame:
    return B.city_documents(spark, sf).where(F.col("review_count") > 0).select("url")


def u8_new_urls(spark: SparkSession, sf: str) -> DataFrame:
    return U.new_urls(B.urls(spark, sf), _stored_urls(spark, sf))


def u8_known_urls(spark: SparkSession, sf: str) -> DataFrame:
    return U.known_urls(B.urls(spark, sf), _stored_urls(spark, sf))


def u9_incremental_words(spark: SparkSession, sf: str) -> DataFrame:
    """Event reviews arriving in three deliveries of ten days, each followed by a run of the job."""
    source, sink = scratch_path(spark, "review-files"), scratch_path(spark, "review-state")
    checkpoint = scratch_path(spark, "review-checkpoint")
    reviews = B.event_reviews(B.table(spark, sf, "events"))
    third = F.least(F.floor((F.dayofmonth("review_day") - 1) / 10), F.lit(2))
    for delivery in range(3):
        reviews.where(third == delivery).write.parquet(f"{source}/delivery={delivery}")
        stream = spark.readStream.schema(REVIEW_FILES).parquet(source)
        docs, _ = run_incremental(stream, sink, checkpoint, B.lexicon(spark), B.city_documents(spark, sf), buckets=4)
    moods = docs.select("city_id", "city_name", "sentiment.*", F.explode("words").alias("item"))
    return moods.select("*", F.col("item.word").alias("word"), F.col("item.weight").alias("weight")).drop("item")


def u10_requeue_stale(spark: SparkSession, sf: str) -> DataFrame:
    cities = B.city_documents(spark, sf).select("city_id", "status", "processed_at")
    return U.requeue_stale(cities, F.lit("2024-01-20 00:00:00").cast("timestamp")).select("city_id", "status")


def x2_url_difference(spark: SparkSession, sf: str) -> DataFrame:
    return U.new_urls(B.urls(spark, sf), H.valid_city_urls(B.urls(spark, sf)))


def x3_url_intersection(spark: SparkSession, sf: str) -> DataFrame:
    return U.known_urls(B.urls(spark, sf), H.valid_city_urls(B.urls(spark, sf)))


# --- addresses and pages ------------------------------------------------------------------------


def p16_valid_urls(spark: SparkSession, sf: str) -> DataFrame:
    return H.valid_city_urls(B.urls(spark, sf))


def p17_classify_urls(spark: SparkSession, sf: str) -> DataFrame:
    return H.classify_urls(B.urls(spark, sf))


def p18_city_code(spark: SparkSession, sf: str) -> DataFrame:
    return B.urls(spark, sf).select("id", city_code(F.col("url")).alias("code"))


def p19_department_of(spark: SparkSession, sf: str) -> DataFrame:
    codes = B.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("code")).distinct()
    return codes.select("code", department_of(F.col("code")).alias("department"))


def city_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per city with heading, total, number of reviews and ratings, beside the pages of the table."""
    c = B.city_documents(spark, sf)

    def line(label: str, name: str) -> Column:
        value = F.col(f"scores.{name}").cast("string")
        return F.concat(F.lit(f"<tr><td>{label} <span>"), value, F.lit("</span></td></tr>"))

    html = F.concat(
        F.lit("<html><body><h1>"), _escaped(F.col("name")), F.lit(" <small>"), "postal_code", F.lit("</small></h1>"),
        F.lit('<div class="total">'), F.col("scores.mean").cast("string"), F.lit("/5</div>"),
        F.lit('<div class="nbtotal">Note sur '), F.col("review_count").cast("string"), F.lit(" commentaires</div>"),
        F.lit('<table class="bloc_chiffre">'), *[line(label, name) for name, label in LABELS.items()], F.lit("</table></body></html>"),
    )
    url = F.concat(F.lit("https://reviews.example/town-"), "city_id", F.lit("/avis.html"))
    return B.pages(spark, sf).select("url", "html").unionByName(c.select(url.alias("url"), html.alias("html")))


def p20_heading_fields(spark: SparkSession, sf: str) -> DataFrame:
    name, postal = H.heading_fields(F.col("h1_html"), F.col("h1_text"))
    raw = H.raw_pages(city_pages(spark, sf))
    return raw.select("url", name.alias("name"), postal.alias("postal_code"))


def p21_city_rows(spark: SparkSession, sf: str) -> DataFrame:
    cities, _ = H.extract_pages(city_pages(spark, sf))
    return cities.select(
        "url", "city_id", "name", "postal_code", "department_id", *[F.col(f"scores.{s}").alias(s) for s in C.SCORES],
        "review_count", "status",
    )


def _escaped(col: Column) -> Column:
    return F.replace(F.replace(F.replace(col, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def review_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One review page per review, with the markup of the review site."""
    r = B.reviews(spark, sf)
    spans = F.concat(*[F.concat(F.lit("<span>"), F.col(c).cast("string"), F.lit("</span>")) for c in C.CATEGORIES])
    total = F.coalesce(F.concat(F.lit('<span class="note_total">'), F.col("score").cast("string"), F.lit("</span>")), F.lit(""))
    html = F.concat(
        F.lit("<html><body><h1>Town <small>01000</small></h1>"),
        F.lit('<div class="commentaire reponse"><p class="description">answer</p></div>'),
        F.lit('<div class="commentaire" data-pouce="'), "review_id", F.lit('"><div class="date">03/02/2024</div>'), total,
        F.lit('<div class="notes">'), spans, F.lit('</div><p class="description">'), _escaped(F.col("description")),
        F.lit('</p><div class="pouce" data-pouce="1"><span>3</span></div></div></body></html>'),
    )
    url = F.concat(F.lit("https://reviews.example/town-"), "city_id", F.lit("/avis.html?page=2"))
    return r.select(url.alias("url"), html.alias("html"))


def p21_review_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, reviews = H.extract_pages(review_pages(spark, sf))
    return reviews.select(
        "review_id", "city_id", "url", "author", "review_day", "score", *[F.col(f"scores.{c}").alias(c) for c in C.CATEGORIES],
        "description", "thumbs_up", "thumbs_down",
    )


def p22_score_and_count_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = B.city_documents(spark, sf)
    note = F.concat(F.col("scores.mean").cast("string"), F.lit("/5"))
    announced = F.concat(F.lit("Note sur "), F.col("review_count").cast("string"), F.lit(" commentaires"))
    return docs.select("city_id", score_text(note).alias("score"), review_count(announced).alias("reviews"))


def p23_pivot_scores(spark: SparkSession, sf: str) -> DataFrame:
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("label"), F.col(f"scores.{name}").cast("string").alias("value"))
        for i, (name, label) in enumerate(LABELS.items())
    ]
    docs = B.city_documents(spark, sf).select("city_id", F.inline(F.array(*rows)))
    return H.pivot_scores(docs, ["city_id"])


def p24_truncate_text(spark: SparkSession, sf: str) -> DataFrame:
    return B.reviews(spark, sf).select("review_id", truncate_text(F.col("description")).alias("excerpt"))


def p25_cap_cities(spark: SparkSession, sf: str) -> DataFrame:
    return U.cap(B.cities(spark, sf).select("city_id", "name"), 10, "city_id")


QUERIES = {f.__name__: f for f in (
    s1_transaction_csv, s1_import_transactions, s2_city_geojson, s2_department_geojson, s2_region_geojson, s2_import_areas,
    s3_write_table, s4_write_areas,
    s5_find, s6_find_one, s7_document_round_trip, s8_csv_export, u1_dedup_insert, u2_upsert_geometry, u3_upsert_stats,
    u4_upsert_documents, u5_unprocessed, u6_mark_processed, u7_purge_counts, u7_purge_rest, u8_new_urls, u8_known_urls,
    u9_incremental_words, u10_requeue_stale, x2_url_difference, x3_url_intersection, p16_valid_urls, p17_classify_urls,
    p18_city_code, p19_department_of, p20_heading_fields, p21_city_rows, p21_review_rows, p22_score_and_count_text,
    p23_pivot_scores, p24_truncate_text, p25_cap_cities,
)}
