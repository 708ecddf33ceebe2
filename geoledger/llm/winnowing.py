"""Document fingerprints by winnowing, over single characters or over pieces of words, in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoledger.llm.common import successors, whole_text
from geoledger.sources.scratch import materialise

#: Pieces of a text: up to three letters or digits counted from the start of a word, or one other visible character.
PIECE = r"[\p{L}\p{N}]{1,3}|[^\p{L}\p{N}\s]"
GRAM = 6
WINDOW = 8
#: Characters of a run, and runs of a window, where single characters are hashed.
CHARACTER_GRAM = 16
CHARACTER_WINDOW = 24
#: Rows of a block of neighbouring documents, on average, until there are so many blocks.
ROWS_PER_BLOCK = 1024
MOST_BLOCKS = 1 << 16
LAST = (1 << 31) - 1


def winnow(df: DataFrame, text: str, out: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add ``out``: array<long> of the selected fingerprints, each hash * 2^31 + (2^31 - 1 - position).

    Every run of ``gram`` pieces has a 32-bit hash; each window of ``window`` runs selects its smallest hash, the rightmost
    of equal ones, and a fingerprint selected by several windows appears once.  Packing the reversed position below the
    hash makes the plain minimum choose the rightmost.  Two texts sharing ``gram + window - 1`` pieces share a fingerprint
    (``positions`` tells where), and only shared runs of ``gram`` pieces can.  A text with fewer runs than a window has one
    window, one with fewer pieces than a run has one run of all its pieces, one without pieces (null, empty, white space)
    has no fingerprint.
    """
    pieces, runs = f"_{out}_pieces", f"_{out}_runs"
    names = ", ".join(f"get({pieces}, i + {j})" for j in range(gram))
    df = df.withColumn(pieces, F.regexp_extract_all(whole_text(text), F.lit(PIECE), F.lit(0)))
    df = df.withColumn(
        runs,
        F.when(F.size(pieces) == 0, F.expr("array_repeat(0L, 0)")).otherwise(
            F.expr(
                f"transform(sequence(0, greatest(size({pieces}) - {gram}, 0)), "
                f"i -> shiftleft(cast(hash({names}) as bigint) & 4294967295L, 31) | (2147483647L - i))"
            )
        ),
    ).drop(pieces)
    return _selected(df, runs, out, window)


def _selected(df: DataFrame, runs: str, out: str, window: int) -> DataFrame:
    """The smallest of every ``window`` neighbouring ``runs`` as ``out``, each once; columns named after ``out`` go."""
    count, current, width = f"{runs}_count", runs, 1
    df = df.withColumn(count, F.size(runs))
    while width < window:  # windows double, the last step overlaps
        step = min(width, window - width)
        wider = f"{runs}_{width + step}"
        least = F.expr(f"zip_with({current}, slice({current}, {step + 1}, size({current})), (x, y) -> least(x, y))")
        df = df.withColumn(wider, least).drop(current)
        current, width = wider, width + step
    full = F.when(F.col(count) == 0, F.col(current)).otherwise(
        F.slice(current, F.lit(1), F.greatest(F.col(count) - (window - 1), F.lit(1)))
    )
    result = df.withColumn(out, F.array_distinct(full))
    return result.drop(*[c for c in result.columns if c.startswith(f"_{out}_")])


def winnow_characters(df: DataFrame, text: str, out: str, gram: int = CHARACTER_GRAM, window: int = CHARACTER_WINDOW) -> DataFrame:
    """``winnow`` over single code points, white space among them, with a rolling hash.

    The hash of a run is the cyclic polynomial: every character has a random 64-bit number (its XXH64), and a run is
    the exclusive or of its characters' numbers, each turned left by one bit for every character after it.  Two
    neighbouring runs give one of both lengths by a turn and an exclusive or, so the hashes roll along the whole text in
    log2(gram) steps.  Two texts that share any ``gram + window - 1`` characters share a fingerprint, wherever the
    passage stands in either: what comes before it changes no hash inside it.  A text shorter than a run is one run.
    """
    n, now, whole = f"_{out}_n", f"_{out}_whole", None
    body = whole_text(text)
    df = df.withColumn(n, F.char_length(body))
    df = df.withColumn(now, F.when(F.col(n) >= gram, F.transform(F.split(body, F.lit(""), -1), lambda c: F.xxhash64(c))))

    def longer(x: str, y: str, more: int) -> str:
        return f"(shiftleft({x}, {more}) | shiftrightunsigned({x}, {64 - more})) ^ {y}" if more % 64 else f"{x} ^ {y}"

    length, width = 0, 1
    for bit in range(gram.bit_length()):  # ``whole``: runs of the lower bits of ``gram``, followed by runs of ``width``
        last = gram >> (bit + 1) == 0
        if gram >> bit & 1:
            if whole is None:
                whole = now
            else:
                wider = f"_{out}_r{length + width}"
                step = F.expr(f"zip_with({whole}, slice({now}, {length + 1}, size({now})), (x, y) -> {longer('x', 'y', width % 64)})")
                df = df.withColumn(wider, step)
                whole = wider
            length += width
        if not last:
            wider = f"_{out}_p{2 * width}"
            step = F.expr(f"zip_with({now}, slice({now}, {width + 1}, size({now})), (x, y) -> {longer('x', 'y', width % 64)})")
            df = df.withColumn(wider, step)
            now, width = wider, 2 * width
    packed = f"transform(slice({whole}, 1, {n} - {gram - 1}), (x, i) -> shiftleft(x & 4294967295L, 31) | ({LAST}L - i))"
    short = F.array(F.shiftleft(F.xxhash64(body).bitwiseAND(F.lit(4294967295)), 31).bitwiseOR(F.lit(LAST).cast("long")))
    runs = F.when(F.col(n) >= gram, F.expr(packed)).when(F.col(n) > 0, short).otherwise(F.expr("array_repeat(0L, 0)"))
    kept = [c for c in df.columns if not c.startswith(f"_{out}_")]
    return _selected(df.select(*kept, runs.alias(f"_{out}_runs")), f"_{out}_runs", out, window)


def _up_to(prints: str, length: Column, gram: int, window: int) -> Column:
    """Of a text's fingerprints those selected by windows that end within its first ``length`` characters.

    A fingerprint is first selected by the window it enters, where its hash is not above that of the fingerprint
    before it, else by the window after that one has left.
    """

    def fits(x: Column, i: Column) -> Column:
        before = F.get(prints, i - 1)
        entering = F.lit(LAST - window + 1) - x.bitwiseAND(F.lit(LAST).cast("long"))
        leaving = F.lit(LAST + 1) - before.bitwiseAND(F.lit(LAST).cast("long"))
        first = F.when(F.shiftright(x, 31) <= F.shiftright(before, 31), entering).otherwise(leaving)
        return F.when(i == 0, length >= gram + window - 1).otherwise(first <= length - (gram + window - 1))

    return F.filter(prints, fits)


def hashes(fingerprints: str) -> Column:
    """The distinct hashes."""
    return F.array_distinct(F.transform(fingerprints, lambda x: F.shiftright(x, 31)))


def positions(fingerprints: str) -> Column:
    """array<struct<hash, position>>: which run of pieces each fingerprint starts at."""
    return F.transform(
        fingerprints,
        lambda x: F.struct(
            F.shiftright(x, 31).alias("hash"), (F.lit(2147483647) - x.bitwiseAND(F.lit(2147483647))).alias("position")
        ),
    )


def digest(fingerprints: str) -> Column:
    """16 hex digits of the fingerprints with their positions: equal texts have equal digests."""
    return F.lower(F.lpad(F.hex(F.xxhash64(F.col(fingerprints), F.size(fingerprints))), 16, "0"))


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two arrays of distinct hashes; two empty ones are alike."""
    shared, either = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(either == 0, F.lit(1.0)).otherwise(shared.cast("double") / (either - shared))


def fingerprint_documents(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``fingerprints`` (array<struct<hash, position>>), row by row and without a shuffle.

    Null keys and repeated rows are kept; a column named ``fingerprints`` is replaced.  See ``winnow`` for empty texts.
    """
    kept = docs.drop("fingerprints")
    return winnow(kept, text, "_selected", gram, window).withColumn("fingerprints", positions("_selected")).drop("_selected")


def _bounds(places: DataFrame, rows_per_block: int) -> DataFrame:
    """One row: the first places of blocks of about ``rows_per_block`` neighbours, ascending; at most MOST_BLOCKS entries."""
    blocks = max(1, min(MOST_BLOCKS, -(-places.count() // rows_per_block)))
    ranged = places.repartitionByRange(blocks, "at").groupBy(F.spark_partition_id().alias("part")).agg(F.min("at").alias("at"))
    return materialise(ranged.agg(F.array_sort(F.collect_list("at")).alias("bounds")), "block-bounds")


def _block(at: str, bounds: str) -> Column:
    """How many bounds are not above a place, by halving."""
    steps = ", ".join(str(1 << k) for k in range(MOST_BLOCKS.bit_length() - 1, -1, -1))
    return F.expr(f"aggregate(array({steps}), 0, (low, step) -> if(get({bounds}, low + step - 1) <= {at}, low + step, low))")


def with_edited(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rows_per_block: int = ROWS_PER_BLOCK,
    gram: int = CHARACTER_GRAM,
    window: int = CHARACTER_WINDOW,
) -> DataFrame:
    """(key, n_chars, edited, own, edited_prints, next_prints) for every document and its edited text.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all) of the next document in
    ascending key, the first document following the last.  Every text is fingerprinted once: of the edited text only the
    characters around the seam are hashed anew, the windows before and behind it are known from the two documents.

    Texts travel once, to blocks of neighbours; inside a block the next row is a window function, and the last row of a
    block takes the first of the following block, found by an ordered join of one small row per block.  Blocks are
    ranges of about ``rows_per_block`` rows by key, text hash and place in the input, so neither far keys nor a key that most rows
    share makes a large one; beyond 65536 blocks, whose bounds every task holds, they grow.

    Null keys come first.  Rows with equal keys follow each other in an order of their texts' hashes.  Null text is empty.  A single row is its
    own next document; an empty table gives no rows; other columns are ignored.
    """
    least = gram + window - 1  # characters that make one window
    known = F.col(key).cast("long")
    place = F.struct(
        known.isNotNull().alias("known"), F.coalesce(known, F.lit(0)).alias("id"),
        F.xxhash64(whole_text(text)).alias("h"), F.monotonically_increasing_id().alias("place"),
    )
    bounds = _bounds(docs.select(place.alias("at")), rows_per_block).scalar()
    thin = docs.select(known.alias("id"), whole_text(text).alias("text"), place.alias("at")).withColumn("bounds", bounds)
    thin = thin.withColumn("block", _block("at", "bounds")).drop("bounds")

    order = Window.partitionBy("block").orderBy("at")
    head = thin.withColumn("row", F.row_number().over(order)).where("row = 1").select("block", F.col("text").alias("head_text"))
    following = successors(thin.select("block")).select(F.col("key").alias("block"), F.col("next_key").alias("head_block"))
    head = head.join(following.select(F.col("block").alias("before"), F.col("head_block").alias("block")), "block")
    head = winnow_characters(head.select(F.col("before").alias("of"), "head_text"), "head_text", "head_prints", gram, window)

    rows = winnow_characters(thin, "text", "own", gram, window)
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_own", F.lead("own").over(order))
    joined = rows.join(head, rows["block"] == head["of"], "left")
    last = F.col("next_text").isNull()
    joined = joined.select(
        "id",
        "text",
        "own",
        F.coalesce("next_text", "head_text").alias("next_text"),
        F.when(last, F.col("head_prints")).otherwise(F.col("next_own")).alias("next_prints"),
        F.char_length("text").alias("n"),
    )
    joined = joined.withColumn("front", F.expr("n - n div 2").cast("int"))
    joined = joined.withColumn("back", F.least(F.expr("int(n div 2)"), F.char_length("next_text")))
    tail, start = F.least("front", F.lit(least - 1)), F.least("back", F.lit(least - 1))
    joined = joined.withColumn("seam", F.concat(F.expr(f"substring(text, front - {least - 2}, {least - 1})"), F.substring("next_text", F.lit(1), start)))
    short = F.col("front") <= least - 1
    joined = joined.withColumn("seam", F.when(short, F.concat(F.substring("text", F.lit(1), F.col("front")), F.substring("next_text", F.lit(1), start))).otherwise(F.col("seam")))
    joined = winnow_characters(joined, "seam", "seam_prints", gram, window)
    # a seam of fewer characters than a window has no window across it, unless it is the whole edited text
    whole = (tail + start >= least) | (F.col("front") + F.col("back") < least)
    seam = F.when(whole, F.transform("seam_prints", lambda x: x - (F.col("front") - tail))).otherwise(F.expr("array_repeat(0L, 0)"))
    behind = F.transform(_up_to("next_prints", F.col("back"), gram, window), lambda x: x - F.col("front"))
    return joined.select(
        F.col("id").alias(key),
        F.col("n").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), F.col("front")), F.substring("next_text", F.lit(1), F.col("back"))).alias("edited"),
        "own",
        F.array_distinct(F.concat(_up_to("own", F.col("front"), gram, window), seam, behind)).alias("edited_prints"),
        "next_prints",
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = with_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sets = pairs.withColumns({f"{c}_set": hashes(c) for c in ("own", "edited_prints", "next_prints")})
    return sets.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        digest("own").alias("fingerprint"),
        digest("edited_prints").alias("edited_fingerprint"),
        likeness("own_set", "edited_prints_set").alias("near_edited"),
        likeness("own_set", "next_prints_set").alias("near_next"),
        F.size("own").cast("long").alias("n_fingerprints"),
    )


QUERIES = {"op8_fingerprints": op8_fingerprints}
ORACLE = {}
