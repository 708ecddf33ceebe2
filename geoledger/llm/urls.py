"""URL filters: dated list entries as validity intervals, and an as-of join with the captures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoledger.sources.scratch import materialise

SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*://"
HOST = SCHEME + r"(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/:?#]*)"
PATH = SCHEME + r"[^/?#]*(/[^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dots, null where the URL is null or has none; IPv6 hosts keep their brackets."""
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path without query, fragment and final slashes; letters keep their case."""
    return F.rtrim(F.regexp_extract(url, PATH, 1), F.lit("/"))


def pattern_key(pattern: Column) -> Column:
    """A host, a host with a path or a whole URL as host and path, written like those of captures; null without a host."""
    whole = F.when(pattern.rlike(SCHEME), pattern).otherwise(F.concat(F.lit("x://"), pattern))
    return F.concat(host_of(whole), path_of(whole))


def suffixes(host: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def prefixes(path: Column) -> Column:
    """The path and all paths above it, the empty one among them."""
    steps = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list_name, kind, pattern, valid_from, valid_to) from dated entries (list_name, kind, pattern, action, dated).

    An ``add`` holds from its date or time until that of the next entry for the same list, kind and pattern (null: still holds).
    Entries of one instant count once; ``add`` wins.  Patterns are taken as ``pattern_key`` writes them.  Entries without list, kind,
    pattern or date, or of another action, are void.
    """
    keys = ["list_name", "kind", "pattern"]
    valid = entries.where(F.col("action").isin("add", "remove") & F.col("dated").isNotNull())
    valid = valid.select("list_name", "kind", pattern_key(F.col("pattern")).alias("pattern"), "action", F.col("dated").alias("valid_from"))
    folded = valid.dropna(subset=keys).groupBy(*keys, "valid_from").agg(F.max(F.col("action") == "add").alias("added"))
    following = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from"))
    return folded.withColumn("valid_to", following).where("added").select(*keys, "valid_from", "valid_to")


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """All columns of ``captures`` plus host, verdict, list_name, pattern, valid_from and valid_to.

    A capture is judged by the entries in force at its fetch time (a date counts as its first instant) whose host is its
    host or a parent domain and whose path, where they have one, is its path or one above it, step by step.  The longest pattern
    decides, then ``block`` before ``allow``, then list name, then pattern.  Verdict is ``block``, ``allow`` or ``none``.
    User, port, query, fragment, final dots and slashes and the case of hosts do not count; the case of paths does.

    The as-of join works by day: for each pattern and day it asks for the interval in force when the day begins, found by one
    ordered pass over days and intervals per list and pattern, and adds those that begin within the day.  A pattern that most
    captures share is thus one row per day there.  The few intervals of a pattern's day then meet the probes of the captures, all
    parent domains and paths above, by an equi-join that AQE can split, and the fetch time picks the one in force.

    No row is dropped: captures with a null or hostless URL, or without a time, get ``none``.  Repeated captures are kept,
    an empty list gives ``none`` everywhere, and columns of ``captures`` with the added names are replaced.
    """
    added = ["host", "verdict", "list_name", "pattern", "valid_from", "valid_to"]
    own = [c for c in captures.columns if c not in added]
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("row")
    located = captures.select(row, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(fetched).alias("at"))
    asked = located.select("host", "path", "at").where("host is not null and at is not null").distinct()
    above = F.flatten(F.transform(suffixes(F.col("host")), lambda h: F.transform(prefixes(F.col("path")), lambda p: F.concat(h, p))))
    probes = asked.select("host", "path", "at", F.col("at").cast("date").alias("day"), F.explode(above).alias("pattern"))

    keys = ["list_name", "kind", "pattern"]
    intervals = materialise(validity_intervals(entries), "url-intervals")
    probes = probes.join(intervals.select("pattern").distinct(), "pattern", "left_semi")  # Spark checks the list's size
    begun = F.struct("kind", "list_name", "pattern", "valid_from", "valid_to")
    days = probes.select("pattern", "day").distinct().join(intervals.select(*keys).distinct(), "pattern")
    moments = days.select(*keys, F.col("day").cast("timestamp").alias("moment"), "day", F.lit(None).cast(intervals.select(begun.alias("b")).schema["b"].dataType).alias("begun"))
    starts = intervals.select(*keys, F.col("valid_from").cast("timestamp").alias("moment"), F.lit(None).cast("date").alias("day"), begun.alias("begun"))
    order = Window.partitionBy(*keys).orderBy("moment", F.col("day").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    latest = starts.unionByName(moments).withColumn("begun", F.last("begun", ignorenulls=True).over(order)).where("day is not null")
    carried = latest.where("begun is not null and (begun.valid_to is null or begun.valid_to > moment)").select("pattern", "day", "begun")
    during = starts.where("moment > date(moment)").select("pattern", F.col("moment").cast("date").alias("day"), "begun")
    # written, so that AQE can split the probes of a pattern that most captures share
    of_day = materialise(carried.unionByName(during).groupBy("pattern", "day").agg(F.collect_list("begun").alias("begun")), "url-days")

    active = F.filter("begun", lambda b: (b["valid_from"] <= F.col("at")) & (b["valid_to"].isNull() | (F.col("at") < b["valid_to"])))
    rank = F.transform(active, lambda b: F.struct((b["kind"] != "block").alias("late"), b["list_name"].alias("list"), b["kind"].alias("kind"), b["valid_from"].alias("f"), b["valid_to"].alias("t")))
    found = probes.join(of_day, ["pattern", "day"]).select("host", "path", "at", "pattern", F.array_min(rank).alias("best")).where("best is not null")
    place = F.struct(-F.length("pattern"), "best.late", "best.list", "best.kind", "pattern")
    best = found.groupBy("host", "path", "at").agg(F.min_by(F.struct("best", "pattern"), place).alias("found"))
    joined = located.join(best, ["host", "path", "at"], "left")
    return joined.select(
        "row.*",
        "host",
        F.coalesce("found.best.kind", F.lit("none")).alias("verdict"),
        F.col("found.best.list").alias("list_name"),
        F.col("found.pattern").alias("pattern"),
        F.col("found.best.f").alias("valid_from"),
        F.col("found.best.t").alias("valid_to"),
    )


START = "2024-01-01 00:00:00"


def _after(minutes: Column) -> Column:
    return F.lit(START).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a fetch time: the page number spread over two years, at any minute of the day."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    minutes = F.pmod("page_id", F.lit(730)) * 1440 + F.pmod(F.col("page_id") * 37, F.lit(1440))
    return pages.select("page_id", "url", _after(minutes).alias("fetched_at"))


def _number(tag: str, of: Column, modulus: int) -> Column:
    digest = F.substring(F.md5(F.concat(F.lit(f"{tag}|"), of)), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(modulus)).cast("int")


def page_lists(captures: DataFrame) -> DataFrame:
    """Dated entries derived from the captured URLs: hosts put on and off a block list within days and within hours, parents blocked,
    hosts allowed, and URLs of sections blocked; in capitals, with ports and final dots, as lists come."""
    whole = captures.select(host_of(F.col("url")).alias("host"), F.split_part(path_of(F.col("url")), F.lit("/"), F.lit(2)).alias("section"))
    whole = whole.where("host is not null").distinct()
    hosts, sections = whole.select("host").distinct(), whole.where("section <> ''")
    host, section = F.col("host"), F.concat("host", F.lit("/"), "section")
    parent = F.regexp_extract("host", r"^[^.]*\.(.*\..*)$", 1)

    def entry(of: DataFrame, name: str, kind: str, pattern: Column, action: str, minutes: Column, key: Column, share: int) -> DataFrame:
        chosen = of.where(_number(name, key, 100) < share)
        return chosen.select(
            F.lit(name).alias("list_name"), F.lit(kind).alias("kind"), pattern.alias("pattern"), F.lit(action).alias("action"),
            _after(minutes).alias("dated"),
        )

    day = 1440
    first, off, again = _number("on", host, 300 * day), _number("off", host, 200 * day), _number("again", host, 200 * day)
    parts = [
        entry(hosts, "spam", "block", host, "add", first, host, 60),
        entry(hosts, "spam", "block", F.concat(F.upper("host"), F.lit(".")), "remove", first + day + off, host, 60),
        entry(hosts, "spam", "block", host, "add", first + 2 * day + off + again, host, 60),
        entry(hosts, "adult", "block", parent, "add", first, host, 40),
        entry(hosts, "adult", "block", parent, "remove", first + 200 * day, host, 40),
        entry(hosts, "trusted", "allow", host, "add", again, host, 30),
        entry(sections, "links", "block", F.concat(F.lit("HTTPS://"), F.upper("host"), F.lit(":443/"), "section", F.lit("/?x")), "add", off, section, 50),
    ]
    nights = hosts.withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(59 * day), F.lit(day))))  # on for three hours, time and again
    parts += [
        entry(nights, "flash", "block", host, "add", first + F.col("start"), host, 20),
        entry(nights, "flash", "block", host, "remove", first + F.col("start") + 180, host, 20),
    ]
    return reduce(DataFrame.unionByName, parts).where("pattern <> ''")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = page_captures(spark, sf_dir)
    judged = filter_urls(captures, page_lists(captures), fetched="fetched_at")
    return judged.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("fetched_at", "valid_from", "valid_to")})


def _sql_number(tag: str, of: str, modulus: int) -> str:
    return f"('0x' || substr(md5('{tag}|' || {of}), 1, 8))::BIGINT % {modulus}"


def _sql_entry(name: str, kind: str, pattern: str, action: str, after: str, of: str = "host", share: int = 0) -> str:
    source = "sections" if of != "host" else "hosts"
    return (
        f"SELECT '{name}' AS list_name, '{kind}' AS kind, {pattern} AS pattern, '{action}' AS action, "
        f"TIMESTAMP '{START}' + to_minutes(({after})::INT) AS dated FROM {source} WHERE {_sql_number(name, of, 100)} < {share}"
    )


_ON, _OFF, _AGAIN = _sql_number("on", "host", 432000), _sql_number("off", "host", 288000), _sql_number("again", "host", 288000)
_PARENT = r"regexp_extract(host, '^[^.]*\.(.*\..*)$', 1)"
_SECTION = "host || '/' || section"
_ENTRIES = "\nUNION ALL ".join(
    [
        _sql_entry("spam", "block", "host", "add", _ON, share=60),
        _sql_entry("spam", "block", "host", "remove", f"{_ON} + 1440 + {_OFF}", share=60),
        _sql_entry("spam", "block", "host", "add", f"{_ON} + 2880 + {_OFF} + {_AGAIN}", share=60),
        _sql_entry("adult", "block", _PARENT, "add", _ON, share=40),
        _sql_entry("adult", "block", _PARENT, "remove", f"{_ON} + 288000", share=40),
        _sql_entry("trusted", "allow", "host", "add", _AGAIN, share=30),
        _sql_entry("links", "block", _SECTION, "add", _OFF, _SECTION, 50),
        _sql_entry("flash", "block", "host", "add", f"{_ON} + unnest(range(0, 86400, 1440))", share=20),
        _sql_entry("flash", "block", "host", "remove", f"{_ON} + 180 + unnest(range(0, 86400, 1440))", share=20),
    ]
)

QUERIES = {"op2_url_filter": op2_url_filter}
ORACLE = {
    "op2_url_filter": rf"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '{START}' + to_minutes(((page_id % 730) * 1440 + page_id * 37 % 1440)::INT) AS fetched_at,
    nullif(rtrim(lower(regexp_extract(url, '{HOST}', 1)), '.'), '') AS host, rtrim(regexp_extract(url, '{PATH}', 1), '/') AS path FROM pages),
sections AS (SELECT DISTINCT host, split_part(path, '/', 2) AS section FROM captures WHERE host IS NOT NULL AND split_part(path, '/', 2) <> ''),
hosts AS (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL),
entries AS ({_ENTRIES}),
folded AS (
  SELECT list_name, kind, pattern, dated AS valid_from, bool_or(action = 'add') AS added FROM entries WHERE pattern <> ''
  GROUP BY ALL),
intervals AS (
  SELECT *, split_part(pattern, '/', 1) AS ph, substr(pattern, 1 + length(split_part(pattern, '/', 1))) AS pp
  FROM (SELECT *, lead(valid_from) OVER (PARTITION BY list_name, kind, pattern ORDER BY valid_from) AS valid_to FROM folded)
  WHERE added),
ranked AS (
  SELECT c.page_id, i.*, row_number() OVER (
    PARTITION BY c.page_id ORDER BY length(i.pattern) DESC, i.kind <> 'block', i.list_name, i.kind, i.pattern) AS place
  FROM captures c JOIN intervals i ON (c.host = i.ph OR ends_with(c.host, '.' || i.ph))
    AND (i.pp = '' OR c.path = i.pp OR starts_with(c.path, i.pp || '/'))
    AND i.valid_from <= c.fetched_at AND (i.valid_to IS NULL OR c.fetched_at < i.valid_to))
SELECT c.page_id, c.url, strftime(c.fetched_at, '%Y-%m-%d %H:%M') AS fetched_at, c.host, coalesce(r.kind, 'none') AS verdict, r.list_name, r.pattern,
  strftime(r.valid_from, '%Y-%m-%d %H:%M') AS valid_from, strftime(r.valid_to, '%Y-%m-%d %H:%M') AS valid_to
FROM captures c LEFT JOIN ranked r ON c.page_id = r.page_id AND r.place = 1
"""
}
