"""Words of reviews: tokens, rules, city lists and their roll-up."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions.codes import sentiment
from geoledger.functions.numbers import percent
from geoledger.functions.text import canonical, is_derived, is_uninformative

#: Bytes of text of a piece (``in_pieces``).
PIECE_BYTES = 8 * 2**20

# --- tokens and rules ---------------------------------------------------------------------------


def split_words(reviews: DataFrame) -> DataFrame:
    """One row per word of each text of at least three characters.

    Splitting the lower-cased text at anything but letters gives the words of ``normalize_text``
    without building the cleaned text first.
    """
    words = F.split(F.lower("description"), r"[^\p{L}]+")
    return (
        reviews.where(F.length("description") >= C.MIN_WORD_LENGTH)
        .select("review_id", "city_id", F.explode(words).alias("token"))
        .where(F.col("token") != "")
    )


def in_pieces(reviews: DataFrame) -> DataFrame:
    """Reviews dealt by id to tasks of about 8 MB of text: a count per review and word then needs no further shuffle of the words,
    and what its task holds does not grow with the table or its files."""
    n_bytes = reviews.agg(F.sum(F.octet_length("description"))).first()[0] or 0
    return reviews.repartition(max(ceil(n_bytes / PIECE_BYTES), reviews.sparkSession.sparkContext.defaultParallelism), "review_id")


def tag(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Attach lemma, part of speech and stop flag; unknown tokens are nouns standing for themselves."""
    return words.join(lexicon.select("token", "lemma", "pos", "is_stop"), "token", "left").withColumns(
        {
            "lemma": F.lower(F.coalesce("lemma", "token")),
            "pos": F.coalesce("pos", F.lit("NOUN")),
            "is_stop": F.coalesce("is_stop", F.lit(False)),
        }
    )


def tokens(reviews: DataFrame, lexicon: DataFrame) -> DataFrame:
    return tag(split_words(reviews), lexicon)


def drop_stopwords(tagged: DataFrame) -> DataFrame:
    return tagged.where(~F.col("is_stop") & ~is_uninformative(F.col("lemma")))


def drop_derived(tagged: DataFrame) -> DataFrame:
    return tagged.where(~is_derived(F.col("lemma")))


def keep_content_words(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("pos").isin(*C.CONTENT_POS) & (F.length("token") >= C.MIN_WORD_LENGTH))


def canonical_lemma(tagged: DataFrame) -> DataFrame:
    return tagged.withColumn("word", canonical(F.col("lemma")))


def significant(tagged: DataFrame) -> DataFrame:
    """All word rules in order."""
    return tagged.transform(drop_stopwords).transform(drop_derived).transform(keep_content_words).transform(canonical_lemma)


# --- city level ---------------------------------------------------------------------------------


def city_word_counts(reviews: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Occurrences of each word per city.

    Equal tokens of a city are counted before the lexicon is joined: the rules depend on the token
    alone, so the join sees one row per (city, token) however often a common word is repeated.
    """
    counted = split_words(reviews).groupBy("city_id", "token").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.transform(tag, lexicon)
        .transform(significant)
        .groupBy("city_id", "word")
        .agg(F.sum("n").alias("weight"))
    )


def top_words(counts: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` heaviest words per key, ties in word order, with their rank."""
    order = W.partitionBy(*keys).orderBy(F.desc("weight"), F.asc("word"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def word_lists(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """Ranked words folded into one ordered array per key; its length is the k of ``top_words``."""
    items = F.array_sort(F.collect_list(F.struct("rank", "word", "weight")))
    return ranked.groupBy(*keys).agg(
        F.transform(items, lambda item: F.struct(item["word"].alias("word"), item["weight"].alias("weight"))).alias("words")
    )


def exploded_words(documents: DataFrame, *keys: str) -> DataFrame:
    """(keys, word, weight, rank) rows of documents with a ``words`` array."""
    return documents.select(*keys, F.posexplode("words").alias("rank", "item")).select(
        *keys, F.col("item.word").alias("word"), F.col("item.weight").alias("weight"), (F.col("rank") + 1).alias("rank")
    )


def city_words(reviews: DataFrame, lexicon: DataFrame, k: int = C.CITY_WORDS) -> DataFrame:
    return top_words(city_word_counts(reviews, lexicon), ["city_id"], k)


def city_sentiment(reviews: DataFrame) -> DataFrame:
    """Reviews per sentiment class and their share of the city's reviews."""
    kind = sentiment(F.col("score"))
    counts = reviews.groupBy("city_id").agg(
        F.count(F.lit(1)).alias("reviews"), *[F.count_if(kind == name).alias(name) for name in C.SENTIMENTS]
    )
    return counts.select(
        "city_id",
        "reviews",
        *C.SENTIMENTS,
        *[percent(F.col(name), F.col("reviews")).alias(f"{name}_percent") for name in C.SENTIMENTS],
    )


def sentiment_struct() -> Column:
    names = [*C.SENTIMENTS, *[f"{name}_percent" for name in C.SENTIMENTS]]
    return F.struct(*names).alias("sentiment")


def city_word_documents(cities: DataFrame, reviews: DataFrame, lexicon: DataFrame, k: int = C.CITY_WORDS) -> DataFrame:
    """One document per known city with reviews: ordered words (possibly none) and sentiment."""
    lists = word_lists(city_words(reviews, lexicon, k), ["city_id"])
    moods = city_sentiment(reviews).select("city_id", sentiment_struct())
    no_words = F.array().cast("array<struct<word:string,weight:bigint>>")
    return (
        cities.select("city_id", F.col("name").alias("city_name"))
        .join(moods, "city_id")
        .join(lists, "city_id", "left")
        .select("city_id", "city_name", F.coalesce("words", no_words).alias("words"), "sentiment")
    )


# --- higher levels ------------------------------------------------------------------------------


def summed_words(words: DataFrame, keys: list[str], k: int) -> DataFrame:
    totals = words.groupBy(*keys, "word").agg(F.sum("weight").alias("weight"))
    return top_words(totals, keys, k)


def department_words(city_docs: DataFrame, cities: DataFrame, k: int = C.AREA_WORDS) -> DataFrame:
    """Heaviest words of each department over its cities' lists."""
    members = cities.where((F.col("review_count") > 0) & (F.col("department_id") != "")).select("city_id", "department_id")
    words = exploded_words(city_docs, "city_id").drop("rank")
    return summed_words(words.join(members, "city_id"), ["department_id"], k)


def region_words(department_docs: DataFrame, k: int = C.AREA_WORDS) -> DataFrame:
    """Heaviest words of each region over its departments' already truncated lists."""
    return summed_words(exploded_words(department_docs, "region_id").drop("rank"), ["region_id"], k)


def national_words(documents: DataFrame, k: int) -> DataFrame:
    totals = exploded_words(documents).groupBy("word").agg(F.sum("weight").alias("weight"))
    return totals.orderBy(F.desc("weight"), F.asc("word")).limit(k)


# --- reading ------------------------------------------------------------------------------------


def word_frequencies(city_docs: DataFrame, city_id: str | None = None) -> DataFrame:
    """Words as a map; one city or all."""
    docs = city_docs if city_id is None else city_docs.where(F.col("city_id") == city_id)
    return docs.select("city_id", F.map_from_entries("words").alias("word_frequencies"))


def sentiment_series(city_docs: DataFrame) -> DataFrame:
    """Three chart rows per city; a city whose sentiment lacks a class fails the query."""
    present = F.lit(True)
    for name in C.SENTIMENTS:
        present = present & F.col(f"sentiment.{name}").isNotNull()
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(C.SENTIMENT_LABELS[name]).alias("label"),
            F.col(f"sentiment.{name}").alias("value"),
            F.lit(C.SENTIMENT_COLOURS[name]).alias("colour"),
        )
        for i, name in enumerate(C.SENTIMENTS, start=1)
    ]
    checked = F.when(present, F.array(*rows)).otherwise(F.raise_error(F.lit("sentiment class missing")))
    return city_docs.select("city_id", F.inline(checked))
