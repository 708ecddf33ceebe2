"""Reports count everything they find; readers and deletes follow names and pages."""

from __future__ import annotations

import json

import pytest

from geoledger.operators import quality as V
from geoledger.operators import rankings as K
from geoledger.operators import upsert as U
from geoledger.sources import files as S
from geoledger.sources.scratch import remove_scratch, scratch_path


def _cities(rows, n):
    schema = "city_id string, name string, scores struct<mean:double>, review_count bigint, department_id string"
    return rows([(str(i), f"c{i}", (9.0,), 1, str(i % 2)) for i in range(n)], schema)


def test_issues_count_all_gaps(rows):
    reviews = rows([(str(i), str(i), 1.0) for i in range(200)], "review_id string, city_id string, score double")
    found = {r["type"]: r for r in V.issues(_cities(rows, 200), reviews).collect()}
    assert found["score_gaps"]["n"] == 200 and found["score_gaps"]["examples"].count(";") == 4


def test_summary_nests_groups_and_refuses_two_lines(rows):
    one, two = rows([(1, None)], "a int, b int"), rows([(1, 2), (3, 4)], "a int, b int")
    document = V.summary_json({"x": one, "y": one.where("a > 5")}).first()["document"]
    assert json.loads(document) == {"x": {"a": 1, "b": None}, "y": None}
    with pytest.raises(Exception, match="more than one line"):
        V.summary_json({"x": one, "y": two}).collect()


def test_departments_rank_on_the_exact_mean(rows):
    cities = _cities(rows, 2)
    reviews = rows(
        [(f"{c}-{i}", str(c), 3.0 + (0.001 if c and i == 0 else 0.0)) for c in (0, 1) for i in range(11)],
        "review_id string, city_id string, score double",
    )
    found = K.best_departments(reviews, cities).collect()
    assert [(r["department_id"], r["mean"]) for r in found] == [("1", 3.0), ("0", 3.0)]


def test_purge_goes_by_page(rows):
    good, quarter = "https://r.example/town-1/avis.html", "https://r.example/town-1/quartier-1/avis.html"
    cities = rows([("1", good), ("1", quarter)], "city_id string, url string")
    reviews = rows([("a", "1", good), ("b", "1", quarter), ("c", "1", None)], "review_id string, city_id string, url string")
    left, kept = U.purge_invalid(cities, reviews, dry_run=False)
    assert [r["url"] for r in left.collect()] == [good] and sorted(r["review_id"] for r in kept.collect()) == ["a", "c"]
    assert {r["item"]: r["rows"] for r in U.purge_invalid(cities, reviews).collect()} == {"cities": 1, "reviews": 1}


def test_csv_files_are_read_by_header(spark, tmp_path):
    from geoledger.schemas import TRANSACTION_HEADER

    names = list(TRANSACTION_HEADER)
    for file, order in (("a.csv", names), ("b.csv", names[::-1] + ["other"])):
        (tmp_path / file).write_text(",".join(order) + "\n" + ",".join(f"{n}-{file}" for n in order) + "\n")
    found = S.read_transactions_csv(spark, str(tmp_path)).collect()
    assert len(found) == 2
    for row in found:
        assert len({row[c].rsplit("-", 1)[1] for c in row.asDict()}) == 1
        assert all(row[column] == f"{header}-{row[column].rsplit('-', 1)[1]}" for header, column in TRANSACTION_HEADER.items())
    with pytest.raises(FileNotFoundError):
        S.read_transactions_csv(spark, str((tmp_path / "none").mkdir() or tmp_path / "none"))


def test_scratch_is_removed(spark):
    path = scratch_path(spark, "kept")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    remove_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_deep_pages_are_read(rows):
    from geoledger.operators import pages as H

    deep = "<html><h1>Town <small>01000</small></h1>" + "<p>" * 5000 + "<div class='total'>3/5</div>"
    raw = H.raw_pages(rows([("u", deep), ("v", None)], "url string, html string")).collect()
    assert raw[0]["total"] == "3/5" and raw[0]["h1_html"] == "<h1>Town <small>01000</small></h1>" and raw[1]["h1_text"] is None


def test_stored_sales_skip_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from geoledger.sources import bindings as B

    path = str(tmp_path / "sales")
    S.write_transactions_by_place(B.transactions(spark, "/root/testdata/sf0.01").where("lon is not null"), path, partitions=16)
    files = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("file"))
        .agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("lon", "lat")])
        .collect()
    )
    met = [f for f in files if f["min_lon"] < 2 and f["max_lon"] > 1 and f["min_lat"] < 45 and f["max_lat"] > 44]
    assert len(files) == 16 and len(met) <= 3


def test_quoted_csv_is_read_in_splits(spark, tmp_path):
    """Line breaks, quotes, separators and carriage returns in fields, in ranges of a few hundred bytes, as the whole-file reader gives them."""
    import random

    draw = random.Random(5)
    header = list(S.TRANSACTION_HEADER)

    def field():
        text = "".join(draw.choice(['a', 'é', '""', '\n', ',', ' b', '\r\n', '']) for _ in range(draw.randrange(9)))
        return f'"{text}"' if draw.random() < 0.8 or any(c in text for c in '",\n\r') else text

    for name, columns in (("one", header), ("two", header[::-1])):
        body = "".join(",".join(["x", *[field() for _ in columns[1:]]]) + "\n" for _ in range(400))
        (tmp_path / f"{name}.csv").write_bytes((",".join(columns) + "\n" + "\n" + body + '"last\n\n\n' + "z" * 2000 + '"' + "," * (len(columns) - 1)).encode())
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("lineSep", "\n")
    want = [tuple(r) for name in ("one", "two") for r in S.rename_header(whole.csv(str(tmp_path / f"{name}.csv"))).collect()]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert S.read_csv_records(spark, str(tmp_path))[0].count() == 2 * 402
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 30
        got = [tuple(r) for r in S.read_transactions_csv(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    order = lambda row: tuple((v is not None, v or "") for v in row)
    assert sorted(got, key=order) == sorted(want, key=order) and len(got) == 802


def test_split_csv_does_not_shuffle_its_lines(spark, tmp_path):
    """Records over Arrow batches of a few lines; whole records stay in the task that read them, only parts of records are dealt out."""
    header = list(S.TRANSACTION_HEADER)
    body = "".join(f'"{i}",' + ",".join('"a\nb ""c""\n"' if i % 7 == j else f"{i}" for j in range(len(header) - 1)) + "\n" for i in range(300))
    (tmp_path / "one.csv").write_text(",".join(header) + "\n" + body)
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("lineSep", "\n").csv(str(tmp_path))
    small = {"spark.sql.files.maxPartitionBytes": "900b", "spark.sql.files.openCostInBytes": "0", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        read = S.read_transactions_csv(spark, str(tmp_path))
        records = S.read_csv_records(spark, str(tmp_path))[0]
        numbers = [r["number"] for r in records.collect()]
        got, plan = sorted(map(tuple, read.collect())), read._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == sorted(map(tuple, S.rename_header(whole).collect())) and len(got) == 300
    assert sorted(numbers) == list(range(1, 302))  # the header is number 1
    assert "Window" not in plan and "Sort " not in plan and plan.count("Aggregate") == 1


def _sales_csv(rows):
    header = list(S.TRANSACTION_HEADER)
    at = {"id_mutation": 0, "id_parcelle": 1, "valeur_fonciere": 2, "latitude": 3, "longitude": 4}
    lines = [",".join(f'"{row[at[name]]}"' if name in at else '"a\nb"' for name in header) for row in rows]
    return "\n".join([",".join(header), *lines, ""])


@pytest.mark.parametrize("split", [None, "500b"])
def test_compressed_csv_is_read_too(spark, tmp_path, split):
    import gzip

    one, two = ([(f"{name}{i}", "p", i, 45, 1) for i in range(50)] for name in "ab")
    (tmp_path / "one.csv").write_text(_sales_csv(one))
    (tmp_path / "two.csv.gz").write_bytes(gzip.compress(_sales_csv(two).encode(), 0))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split or size)
    try:
        got = S.read_transactions_csv(spark, str(tmp_path)).select("tx_id", "parcel_id", "price", "lat", "lon", "city_name").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(map(tuple, got)) == sorted((*map(str, row), "a\nb") for row in one + two)


def test_import_deals_out_new_sales_only_and_leaves_no_shuffles(spark, tmp_path):
    """Stored sales are written along as they lie, in files of their own; sales of the same key are not added, copies once."""
    import time
    from pathlib import Path

    from pyspark.sql import functions as F

    from geoledger.operators.imports import import_transactions

    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {str(f) for d in manager.localDirs() for f in Path(d.getPath()).rglob("shuffle_*")}
    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(key)
    first = [(f"t{i}", "p", 1, 42 + i % 9, i % 14) for i in range(0, 200, 2)]
    second = [(f"t{i}", "p", 2, 42 + i % 9, i % 14) for i in range(200)] + [("t1", "p", 2, 43, 1), ("none", "p", 2, "", 1)]
    for name, rows, previous in (("1", first, None), ("2", second, str(tmp_path / "out1"))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(_sales_csv(rows))
        stored = import_transactions(spark, str(tmp_path / name), str(tmp_path / f"out{name}"), previous)
    until = time.time() + 20
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(key) == kept
    assert sorted((r["tx_id"], r["price"]) for r in stored.collect()) == sorted((f"t{i}", 1.0 + i % 2) for i in range(200))
    files = stored.groupBy(F.input_file_name()).agg(F.count_distinct("price").alias("kinds")).collect()
    assert len(files) > 1 and all(f["kinds"] == 1 for f in files)


def test_imported_files_are_deleted(spark):
    from pathlib import Path

    from geoledger.plans import ingest
    from geoledger.sources.scratch import scratch_path

    folder = Path(scratch_path(spark, "x")).parent
    before = set(folder.glob("transactions-csv-*")) if folder.exists() else set()
    assert ingest.s1_import_transactions(spark, "/root/testdata/sf0.001").count() > 1000
    assert set(folder.glob("transactions-csv-*")) <= before


def test_parsed_pages_are_let_go_of():
    """No cycles are left for the collector, and a batch is handed on in small frames."""
    import gc

    import pandas as pd

    from geoledger.operators import pages as H

    gc.collect()
    gc.disable()
    try:
        seen = [len(frame) for frame in H._read_batches(iter([pd.DataFrame({"url": ["u"] * 600, "html": ["<div><h1>a<p>b</p></h1></div>"] * 600})]))]
        left = sum(isinstance(x, H._Node) for x in gc.get_objects())
    finally:
        gc.enable()
    assert sum(seen) == 600 and max(seen) <= H.PAGES_AT_ONCE
    assert left == 0


def test_write_table_bounds_what_a_task_reads(spark, tmp_path):
    """``partitions`` tasks for a small table, more for a larger one."""
    target, size = str(tmp_path / "t"), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    df = spark.range(200_000, numPartitions=16).selectExpr("id", "sha2(string(id), 256) AS text")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        S.write_table(df, target, partitions=2)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    stored = spark.read.parquet(target)
    assert len(stored.inputFiles()) > 6 and stored.count() == stored.select("id").distinct().count() == 200_000
