"""Readers and writers: transaction CSV, boundary GeoJSON, nested documents, tables, exports."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from geoledger import schemas as S
from geoledger.functions import geometry as G
from geoledger.operators.transactions import rename_header
from geoledger.schemas import TRANSACTION_HEADER
from geoledger.sources import records as R
from geoledger.sources.scratch import materialise


#: Most columns a CSV file may have.
CSV_WIDTH = 64


def _csv_values(text: str, width: int = CSV_WIDTH) -> Column:
    """The first ``width`` fields of one CSV record, null where it has fewer; quotes inside quoted fields are doubled."""
    names = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(F.col(text), ", ".join(f"{name} string" for name in names), {"escape": '"', "maxColumns": str(CSV_WIDTH)})
    # bound as a variable: a record is parsed once, not once per field
    return F.get(F.transform(F.array(parsed), lambda p: F.array(*[p[name] for name in names])), F.lit(0))


def read_csv_records(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(file, number, record) of every record of the CSV files of a folder, and (file, header); both split inside files.

    A line break ends a record where an even number of quotes comes before it.  Quotes are counted per byte range, a range's
    parity and number of records follow from the ranges before it in the file, and so each range knows which of its lines begin
    records, without reading another one.  A task reads its ranges in order and joins the lines of a record as they come; only the
    parts of records that reach into another range, two per range at most, are shuffled.  Records are numbered from 1, the header; a
    header is one line.  Empty lines are no records.
    """
    read = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.csv").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    lines = read.select("value", *place, F.monotonically_increasing_id().alias("line"))
    headers = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    headers = materialise(headers.withColumn("fid", F.xxhash64("file")), "csv-files")  # one row per file
    if headers.groupBy("fid").count().where("count > 1").count():
        raise ValueError(f"two files of {path} share a hash")

    lines = lines.select(F.xxhash64("file").alias("fid"), "start", "value")
    ranges = lines.select("fid", "start", quotes.cast("int").alias("quotes")).mapInArrow(R.count_ranges, R.COUNTS)
    earlier = W.partitionBy("fid").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("open", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("open") == 0, F.col("begun0")).otherwise(F.col("begun1"))
    ranges = ranges.withColumn("begun", begun).withColumn("records", F.coalesce(F.sum("begun").over(earlier), F.lit(0)))
    broken = (F.col("open") == 1) | (F.lead("open").over(W.partitionBy("fid").orderBy("start")) == 1)
    ranges = ranges.withColumn("broken", F.coalesce(broken, F.lit(False)))
    ranges = materialise(ranges.select("fid", "start", "open", "records", "broken"), "csv-ranges")  # one row per range

    moved = F.raise_error(F.lit("files were split otherwise when they were read again")).cast("long")
    marked = lines.join(F.broadcast(ranges), ["fid", "start"], "left").withColumn("open", F.coalesce("open", moved))
    given = ["fid", "start", "value", "open", "records"]
    whole = marked.select(*given).mapInArrow(R.records_of(parts_only=False), R.RECORDS).select("fid", "number", "record")
    parts = marked.where("broken").select(*given).mapInArrow(R.records_of(parts_only=True), R.RECORDS)
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("start", "record"))), lambda p: p["record"])
    longer = parts.groupBy("fid", "number").agg(F.array_join(pieces, "\n").alias("record"))
    ending = lambda text: F.regexp_replace(text, "\\r$", "")
    records = whole.unionByName(longer).withColumn("record", ending("record")).where("record <> ''")
    records = records.join(F.broadcast(headers.select("fid", "file")), "fid").select("file", "number", "record")
    return records, headers.select("file", F.regexp_replace(ending("header"), "^\ufeff", "").alias("header"))


def _split_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Large files, read in splits; columns by the header of their file."""
    records, headers = read_csv_records(spark, paths)
    names = materialise(headers.select("file", _csv_values("header").alias("names")), "csv-headers")  # one row per file
    last = F.array_max(F.array(*[F.array_position("names", F.lit(source)) for source in TRANSACTION_HEADER]))
    width = max(names.agg(F.max(last)).first()[0], 1)  # a record is parsed up to the last field in use
    # one row out for one in: what stands below the generator is not evaluated again for every column
    fields = records.where("number > 1").join(F.broadcast(names), "file").select("names", F.explode(F.array(_csv_values("record", width))).alias("values"))

    def column(source: str) -> Column:
        at = F.array_position("names", F.lit(source)).cast("int")
        lacking = F.raise_error(F.lit(f"a file lacks the column {source}")).cast("int")
        return F.get("values", F.when(at > 0, at - 1).otherwise(lacking)).alias(source)

    return fields.select(*[column(source) for source in TRANSACTION_HEADER])


def _whole_csv(spark: SparkSession, paths: list[str], multi_line: bool) -> list[DataFrame]:
    """One scan per header; the headers of all files are read in one pass."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line")
    )
    scans: dict[tuple[str, ...], list[str]] = {}
    for row in lines.groupBy("file").agg(F.min_by("value", "line").alias("header")).orderBy("file").collect():
        header = tuple(next(csv.reader([row["header"].removeprefix("\ufeff").rstrip("\r")])))
        scans.setdefault(header, []).append(unquote(row["file"]))
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    layouts = {header: StructType([StructField(name, StringType()) for name in header]) for header in scans}
    return [reader.schema(layouts[header]).csv(some) for header, some in scans.items()]


def read_transactions_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All CSV files of a folder, also compressed ones (``.csv.gz``), every column as text so codes keep leading zeros.

    Files larger than a split are read in splits, also where fields hold line breaks (``read_csv_records``); smaller ones and compressed
    ones, which cannot be split, are one task each.  Both give the same rows.  Columns are found by header name, file by file, so a file whose columns stand in another
    order is read right; one that lacks a column fails the query.  ``multi_line=False`` is for files without line breaks
    in fields, which Spark splits by itself.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.{csv,csv.gz}").load(path).select("path", "length").collect()
    if not listed:
        raise FileNotFoundError(f"no CSV file in {path}")
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    large = {row["path"] for row in listed if multi_line and row["length"] > split and row["path"].endswith(".csv")}
    small = [row["path"] for row in listed if row["path"] not in large]
    scans = ([_split_csv(spark, sorted(large))] if large else []) + (_whole_csv(spark, small, multi_line) if small else [])
    return reduce(DataFrame.unionByName, [rename_header(scan) for scan in scans])


def read_areas_geojson(spark: SparkSession, path: str, level: str, partitions: int | None = None) -> DataFrame:
    """Areas of a level with multipolygon and bounding box; geometry text is parsed by its type.

    One line holds a whole collection and so one task reads it; ``partitions`` spreads its features
    before the geometry is parsed.
    """
    fields = {
        "city": {"city_id": "code", "name": "nom", "department_id": "departement", "region_id": "region"},
        "department": {"department_id": "code", "name": "nom", "region_id": "region"},
        "region": {"region_id": "code", "name": "nom"},
    }
    if level not in fields:
        raise ValueError(f"unknown level: {level}")
    features = spark.read.schema(S.FEATURE_COLLECTION).json(path).select(F.inline("features"))
    if partitions:
        features = features.repartition(partitions, "properties.code")
    shape = G.parse_coordinates("geometry.coordinates", "geometry.type")
    areas = features.select(
        *[F.col(f"properties.{source}").alias(name) for name, source in fields[level].items()], shape.alias("geometry")
    )
    return G.with_bbox(areas.withColumn("geometry", G.repair_rings("geometry")))


def write_table(
    df: DataFrame, target: str, mode: str = "overwrite", partitions: int | None = None, format: str = "parquet", **options: str
) -> None:
    """Write a table; ``format="jdbc"`` with connection options loads a database (target = table).

    ``partitions`` is the number of connections to a database.  Of files it is the number of tasks the rows are dealt to; AQE
    splits those that would read more than its advisory size and joins small ones, so a task's share does not grow with the table.
    """
    if partitions:
        df = df.repartition(partitions) if format == "jdbc" else df.hint("rebalance", partitions)
    writer = df.write.mode(mode).format(format).options(**options)
    if format == "jdbc":
        writer.option("dbtable", target).option("batchsize", options.get("batchsize", "10000")).save()
    else:
        writer.save(target)


def write_areas(areas: DataFrame, target: str, mode: str = "overwrite") -> None:
    """Boundary rows that have a geometry, dealt to files by place and sorted, so that box columns prune files and row groups."""
    kept = areas.where(F.col("geometry").isNotNull())
    kept.repartitionByRange("min_x", "min_y").sortWithinPartitions("min_x", "min_y").write.mode(mode).parquet(target)


def write_transactions(tx: DataFrame, target: str, mode: str = "overwrite") -> None:
    """Sales partitioned by year and sorted by city inside files."""
    (
        tx.withColumn("year", F.year("tx_date"))
        .sortWithinPartitions("year", "city_id")
        .write.mode(mode)
        .partitionBy("year")
        .parquet(target)
    )


def write_transactions_by_place(
    tx: DataFrame,
    target: str,
    mode: str = "overwrite",
    cell: float = 1.0,
    partitions: int | None = None,
    stored: DataFrame | None = None,
) -> None:
    """Sales dealt to files by ranges of grid cells and sorted by cell inside, so that a viewport skips most of them.

    The position breaks ties of a crowded cell, so it is spread over several files.  Rows of ``stored``, which lie by place already,
    are written along as scanned.
    """
    keys = ["i", "j", "lon", "lat", "tx_id"]
    placed = G.with_cell(tx, cell)
    dealt = placed.repartitionByRange(*([partitions] if partitions else []), *keys).sortWithinPartitions(*keys)
    dealt = dealt.drop("i", "j")
    (dealt if stored is None else stored.unionByName(dealt)).write.mode(mode).parquet(target)


def read_docs(spark: SparkSession, path: str, schema: str, format: str = "json") -> DataFrame:
    """Nested documents with a declared schema."""
    return spark.read.schema(schema).format(format).load(path)


def write_docs(df: DataFrame, path: str, mode: str = "overwrite", format: str = "json") -> None:
    df.write.mode(mode).format(format).save(path)


def find(df: DataFrame, predicate: Column | None = None, fields: list[str] | None = None) -> DataFrame:
    """Documents that match, reduced to some fields."""
    rows = df if predicate is None else df.where(predicate)
    return rows if fields is None else rows.select(*fields)


def find_one(df: DataFrame, predicate: Column | None = None, fields: list[str] | None = None, key: str | None = None) -> DataFrame:
    """First matching document in key order."""
    rows = df if predicate is None else df.where(predicate)
    rows = rows.orderBy(key or df.columns[0]).limit(1)
    return rows if fields is None else rows.select(*fields)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV file with header, for rankings; what comes before the one writer stays spread over all tasks."""
    df.repartition(1).write.mode(mode).option("header", True).csv(path)
