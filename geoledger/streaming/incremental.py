"""Incremental text job: new review files in, refreshed city words and sentiment out.

State is a set of parquet tables under one folder, each written per batch and hash bucket: ``reviews`` as
delivered, ``items`` (class and words of every review, by bucket of the review), ``counters`` (reviews per
city and word, and per city and class) and ``cities`` (documents), both by bucket of the city.  A batch adds
what its reviews count and takes away what the versions they replace counted, wherever these were counted, so
it never reads an earlier text, and it rewrites counters and documents of the buckets it touches only.

``done`` names, batch by batch, the folders that make up the state.  A bucket that has gathered a number of
item folders gets one ``merged`` folder with the newest version of every review, and its earlier ones leave
the state; so a batch reads at most that many folders of a bucket, however many batches went before.  The
pointer moves last.  A batch reads what the batch before left and overwrites folders named after itself, so
one that is replayed leaves the same state, also where it merges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions.codes import sentiment
from geoledger.functions.numbers import percent
from geoledger.operators.upsert import first_per_key, mark_processed, unprocessed
from geoledger.operators.words import sentiment_struct, significant, split_words, tag, top_words, word_lists
from geoledger.schemas import SENTIMENT, WORDS

BUCKETS = 64
#: Item folders of a bucket that are read before they are merged into one.
MERGE_AFTER = 16
KEY = ["bucket", "review_id"]
STATE = "name string, bucket int, folder int"
REVIEWS = "review_id string, city_id string, score double, description string, bucket int"
ITEMS = f"bucket int, city_id string, review_id string, class string, words {WORDS}"
COUNTERS = "bucket int, city_id string, kind string, name string, n bigint"
CITIES = f"bucket int, city_id string, words {WORDS}, sentiment {SENTIMENT}"


def _store(df: DataFrame, sink: str, table: str, batch_id: int) -> None:
    df.write.mode("overwrite").partitionBy("bucket").parquet(f"{sink}/{table}/batch={batch_id}")


def _read(spark: SparkSession, sink: str, table: str, schema: str, folders: list[tuple[int, int]]) -> DataFrame:
    """Rows of the given (batch, bucket) folders, with their batch."""
    if not folders:
        return spark.createDataFrame([], f"{schema}, batch int")
    paths = [f"{sink}/{table}/batch={batch}/bucket={bucket}" for batch, bucket in folders]
    return spark.read.schema(f"{schema}, batch int").option("basePath", f"{sink}/{table}").parquet(*paths)


def _state(spark: SparkSession, sink: str, before: int | None = None) -> tuple[int, list[Row]]:
    """Newest finished batch, of all or of those before one, and the (name, bucket, folder) rows it left: a bounded number."""
    done = spark.read.schema(f"{STATE}, batch int").parquet(f"{sink}/done")
    done = done if before is None else done.where(F.col("batch") < before)
    rows = done.collect()
    newest = max((row["batch"] for row in rows), default=-1)
    return newest, [row for row in rows if row["batch"] == newest]


def _finish(spark: SparkSession, sink: str, batch_id: int, previous: int, rows: list[tuple[str, int, int]]) -> None:
    """Name the folders of the state after this batch, and forget the lists that no replay can need."""
    spark.createDataFrame(rows, STATE).coalesce(1).write.mode("overwrite").parquet(f"{sink}/done/batch={batch_id}")
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/done")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("batch=") and int(name.removeprefix("batch=")) < previous:
            fs.delete(status.getPath(), True)


def _read_items(spark: SparkSession, sink: str, live: dict[int, list[tuple[str, int]]]) -> DataFrame:
    """Items of the given folders of buckets, with their batch."""
    parts = [[(folder, bucket) for bucket, folders in live.items() for name, folder in folders if name == table] for table in ("items", "merged")]
    return _read(spark, sink, "items", ITEMS, parts[0]).unionByName(_read(spark, sink, "merged", ITEMS, parts[1]))


def _newest(items: DataFrame) -> DataFrame:
    """Newest version of every review."""
    return first_per_key(items.withColumn("_age", -F.col("batch")), KEY, ["_age"]).drop("_age", "batch")


def _items(reviews: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Class and words of every review; equal tokens of a review meet the lexicon once."""
    counted = split_words(reviews).groupBy("city_id", "review_id", "token").agg(F.count(F.lit(1)).alias("n"))
    words = counted.transform(tag, lexicon).transform(significant)
    words = words.groupBy("city_id", "review_id", "word").agg(F.sum("n").alias("weight"))
    lists = words.groupBy("city_id", "review_id").agg(F.collect_list(F.struct("word", "weight")).alias("words"))
    none = F.array().cast(WORDS)
    classes = reviews.select(*KEY, "city_id", sentiment(F.col("score")).alias("class"))
    return classes.join(lists, ["city_id", "review_id"], "left").select(*KEY, "city_id", "class", F.coalesce("words", none).alias("words"))


def _counts(items: DataFrame, sign: int) -> DataFrame:
    """(bucket, city_id, kind, name, n) of the items, counted up or down."""
    classes = items.select("bucket", "city_id", F.lit("class").alias("kind"), F.col("class").alias("name"), F.lit(1).alias("weight"))
    words = items.select("bucket", "city_id", F.lit("word").alias("kind"), F.inline("words"))
    both = classes.unionByName(words.withColumnRenamed("word", "name"))
    return both.groupBy("bucket", "city_id", "kind", "name").agg((sign * F.sum("weight")).alias("n"))


def _documents(counters: DataFrame) -> DataFrame:
    words = counters.where("kind = 'word'").select("bucket", "city_id", F.col("name").alias("word"), F.col("n").alias("weight"))
    lists = word_lists(top_words(words, ["city_id"], C.CITY_WORDS), ["city_id"])
    classes = counters.where("kind = 'class'").groupBy("bucket", "city_id")
    sums = classes.agg(*[F.sum(F.when(F.col("name") == c, F.col("n")).otherwise(0)).alias(c) for c in C.SENTIMENTS])
    total = reduce(lambda a, b: a + b, [F.col(c) for c in C.SENTIMENTS])
    shares = sums.withColumns({f"{c}_percent": percent(F.col(c), total) for c in C.SENTIMENTS})
    moods = shares.select("bucket", "city_id", sentiment_struct())
    return moods.join(lists, "city_id", "left").select("bucket", "city_id", F.coalesce("words", F.array().cast(WORDS)).alias("words"), "sentiment")


def _buckets(df: DataFrame) -> list[int]:
    return sorted(row["bucket"] for row in df.select("bucket").distinct().collect())  # at most as many numbers as buckets


def process_batch(
    batch: DataFrame, batch_id: int, sink: str, lexicon: DataFrame, buckets: int = BUCKETS, merge_after: int = MERGE_AFTER
) -> None:
    """Store one batch, apply its differences and refresh the buckets it touches.

    A review delivered again replaces its earlier version, also one counted under another city; of equal reviews in one batch the
    first by score, text and city counts.  Reviews without city or key are void.
    """
    spark = lexicon.sparkSession

    def bucket_of(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")

    def again(table: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{sink}/{table}/batch={batch_id}")

    new = batch.dropna(subset=["city_id", "review_id"]).select("review_id", "city_id", "score", "description")
    new = new.withColumn("bucket", bucket_of("review_id"))
    _store(first_per_key(new, KEY, ["score", "description", "city_id"]), sink, "reviews", batch_id)
    stored = again("reviews", REVIEWS)
    _store(_items(stored, lexicon), sink, "items", batch_id)
    items = again("items", ITEMS)

    previous, state = _state(spark, sink, batch_id)
    hit = _buckets(stored)
    live = {bucket: [(r["name"], r["folder"]) for r in state if r["bucket"] == bucket and r["name"] in ("items", "merged")] for bucket in hit}
    earlier = _newest(_read_items(spark, sink, live))
    _store(earlier.join(stored.select(*KEY), KEY, "left_semi"), sink, "replaced", batch_id)
    replaced = again("replaced", ITEMS)

    full = {bucket: folders for bucket, folders in live.items() if len(folders) >= merge_after}
    if full:
        rest = _newest(_read_items(spark, sink, full)).join(stored.select(*KEY), KEY, "left_anti")
        _store(rest.unionByName(items.where(F.col("bucket").isin(*full))), sink, "merged", batch_id)

    by_city = [_counts(df.withColumn("bucket", bucket_of("city_id")), sign) for df, sign in ((items, 1), (replaced, -1))]
    touched = _buckets(items.select("city_id").union(replaced.select("city_id")).select(bucket_of("city_id").alias("bucket")))
    counters = _read(spark, sink, "counters", COUNTERS, [(r["folder"], r["bucket"]) for r in state if r["name"] == "counters" and r["bucket"] in touched])
    changed = counters.drop("batch").unionByName(by_city[0]).unionByName(by_city[1])
    changed = changed.groupBy("bucket", "city_id", "kind", "name").agg(F.sum("n").alias("n")).where("n > 0")
    _store(changed, sink, "counters", batch_id)
    _store(_documents(again("counters", COUNTERS)), sink, "cities", batch_id)

    kept = [(r["name"], r["bucket"], r["folder"]) for r in state]
    kept = [r for r in kept if r[1] not in (full if r[0] in ("items", "merged") else touched)]
    kept += [("merged" if bucket in full else "items", bucket, batch_id) for bucket in hit]
    kept += [(table, bucket, batch_id) for bucket in _buckets(again("counters", COUNTERS)) for table in ("counters", "cities")]
    _finish(spark, sink, batch_id, previous, kept)


def documents(spark: SparkSession, sink: str, cities: DataFrame) -> DataFrame:
    """Current documents of the known cities: each bucket as its newest finished batch left it."""
    _, state = _state(spark, sink)
    docs = _read(spark, sink, "cities", CITIES, [(r["folder"], r["bucket"]) for r in state if r["name"] == "cities"])
    names = cities.select("city_id", F.col("name").alias("city_name"))
    return names.join(docs, "city_id").select("city_id", "city_name", "words", "sentiment")


def run_incremental(
    reviews: DataFrame, sink: str, checkpoint: str, lexicon: DataFrame, cities: DataFrame, buckets: int = BUCKETS
) -> tuple[DataFrame, DataFrame]:
    """Process all review files that arrived since the last run; the current documents and the flagged cities.

    ``reviews`` is a streaming frame with review_id, city_id, score, description.  Every city that waited is flagged
    processed, those without a review too; the others keep their state.  Reviews are known as processed by their item.
    A run without new files changes no document.
    """
    nothing = lexicon.sparkSession.createDataFrame([], STATE)
    nothing.write.mode("overwrite").parquet(f"{sink}/done/batch=-1")  # a first run may find no file
    query = (
        reviews.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: process_batch(batch, batch_id, sink, lexicon, buckets))
        .start()
    )
    query.awaitTermination()
    return documents(lexicon.sparkSession, sink, cities), mark_processed(cities, unprocessed(cities))
