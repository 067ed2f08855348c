"""URL filters by a temporal list join.

List events (pattern, at, listed or not) become validity intervals; a
capture asks for its own time, and an as-of join returns the entries that
were active then. Patterns are a host or a parent domain of it of two labels
or more, alone or with any number of leading path segments, in lower case. A
capture looks up all its patterns by equality, as deep as the longest entry
of the list goes, and the interval decides; a pattern's intervals do not
meet, so a capture and a pattern give one row at most. Spark splits the
partition of a pattern that very many captures share; the events of one
pattern are at most one per list release.

Defined results: a null, empty or malformed URL, or a null time, matches
nothing and is not blocked; events with a null pattern or time say nothing;
of events of one pattern at one time, listing wins; repeated captures each
get their row; empty tables give an empty result or one without matches;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, read

#: the list made from the pages (events_of) names these patterns; lookups have no such bound
LISTED_STARTS, LISTED_SEGMENTS = 8, 2
_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?(/[^?#]*)?"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1))


def segments_of(url: Column) -> Column:
    return F.filter(F.split(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)), "/"), lambda s: s != "")


def patterns_of(url: Column, most_labels: int, most_segments: int) -> Column:
    """All patterns of up to ``most_labels`` labels and ``most_segments`` path
    segments that can list ``url``: host and parent domains of two labels or
    more, each alone and with leading segments."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.greatest(n - F.lit(max(2, most_labels)), F.lit(0)), F.greatest(n - 2, F.lit(0))),
                          lambda i: F.array_join(F.slice(labels, i + 1, n - i), "."))
    segments = segments_of(url)
    paths = F.transform(F.sequence(F.lit(0), F.least(F.size(segments), F.lit(most_segments))), lambda i: F.slice(segments, 1, i))
    both = F.flatten(F.transform(domains, lambda d: F.transform(paths, lambda p: F.array_join(F.concat(F.array(d), p), "/"))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(both))


def longest(listed: DataFrame) -> tuple[int, int]:
    """Most labels and most path segments of a listed pattern."""
    parts = F.split("pattern", "/")
    top = listed.agg(F.max(F.size(F.split(parts[0], r"\."))), F.max(F.size(parts) - 1)).first()
    return top[0] or 0, top[1] or 0


def intervals(events: DataFrame) -> DataFrame:
    """(pattern, valid_from, valid_to) of (pattern, at, listed) events; valid_to is open (null) for entries never taken off."""
    at_once = events.filter("pattern is not null and at is not null").groupBy("pattern", "at").agg(F.max("listed").alias("listed"))
    w = Window.partitionBy("pattern").orderBy("at")
    runs = at_once.withColumn("was", F.lag("listed").over(w)).filter("was is null or was <> listed")
    ends = runs.withColumn("valid_to", F.lead("at").over(w))
    return ends.filter("listed").select("pattern", F.col("at").alias("valid_from"), "valid_to")


def filter_urls(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at") -> DataFrame:
    """page_id, url, fetched_at, blocked, n_entries, pattern (the longest active entry, ties by name) and listed_since."""
    rows = cut(captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched_at"),
                               F.monotonically_increasing_id().alias("uid")))
    listed = cut(intervals(events))
    asked = rows.select("uid", "fetched_at", F.explode(patterns_of(F.col("url"), *longest(listed))).alias("asked"))
    active = asked.join(listed, (F.col("asked") == F.col("pattern")) & (F.col("fetched_at") >= F.col("valid_from"))
                        & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))))
    best = F.max(F.struct(F.length("pattern").alias("n"), "pattern", "valid_from")).alias("best")
    hits = active.groupBy(F.col("uid").alias("_uid")).agg(F.count("*").alias("n"), best)
    return rows.join(hits, F.col("uid") == F.col("_uid"), "left").select(
        "page_id", "url", "fetched_at", F.col("n").isNotNull().alias("blocked"), F.coalesce("n", F.lit(0)).cast("long").alias("n_entries"),
        F.col("best.pattern").alias("pattern"), F.col("best.valid_from").alias("listed_since"))


def _number(salt: str, x: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), x)), 1, 8), 16, 10).cast("long")


def captures_of(pages: DataFrame) -> DataFrame:
    """The page table has no fetch time; each page gets one of January 2024 from its id."""
    at = F.timestamp_seconds(F.lit(1704067200) + _number("t", F.col("page_id").cast("string")) % (30 * 86400))
    return pages.select("page_id", "url", at.cast("timestamp").alias("fetched_at"))


def listed_patterns(url: Column) -> Column:
    """What the made list draws from: host, its first parent domains, host with leading segments."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(0), F.least(F.greatest(n - 2, F.lit(0)), F.lit(LISTED_STARTS))),
                          lambda i: F.array_join(F.slice(labels, i + 1, n - i), "."))
    segments = segments_of(url)
    paths = F.transform(F.sequence(F.lit(1), F.least(F.size(segments), F.lit(LISTED_SEGMENTS))),
                        lambda i: F.concat_ws("/", host, F.slice(segments, 1, i)))
    none = F.array().cast("array<string>")
    return F.when(host == "", none).otherwise(
        F.array_distinct(F.concat(parents, F.when(F.size(segments) > 0, paths).otherwise(none))))


def events_of(pages: DataFrame) -> DataFrame:
    """A dated list over the patterns of the pages: a third of them is listed
    at some time, half of these is taken off after 4 days, a fifth listed again after 9."""
    p = pages.select(F.explode(listed_patterns(F.col("url"))).alias("pattern")).distinct().withColumn("h", _number("l", F.col("pattern"))).filter("h % 3 = 0")
    first = F.lit(1704067200) + F.col("h") % 1728000
    steps = F.array(*[F.struct((first + 86400 * d).alias("s"), F.lit(on).alias("listed"), (F.col("h") % m == 0).alias("use"))
                      for d, on, m in ((0, True, 1), (4, False, 2), (9, True, 5))])
    e = p.select("pattern", F.explode(steps).alias("e")).filter("e.use")
    return e.select("pattern", F.timestamp_seconds("e.s").alias("at"), F.col("e.listed").alias("listed"))


def query(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return filter_urls(captures_of(pages), events_of(pages)).withColumn("fetched_at", F.unix_timestamp("fetched_at")).withColumn(
        "listed_since", F.unix_timestamp("listed_since"))


ORACLE = r"""
WITH u AS (SELECT row_number() OVER () AS uid, page_id, url,
    1704067200 + CAST('0x' || substr(md5('t' || CAST(page_id AS VARCHAR)), 1, 8) AS BIGINT) % 2592000 AS fetched_at,
    lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?(/[^?#]*)?', 1)) AS host,
    list_filter(string_split(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?(/[^?#]*)?', 2)), '/'),
      lambda s: s <> '') AS seg FROM pages),
asked AS (SELECT DISTINCT uid, fetched_at, pattern FROM (
    SELECT uid, fetched_at, unnest(list_transform(range(0, least(greatest(len(string_split(host, '.')) - 2, 0), 8) + 1),
      lambda i: array_to_string(string_split(host, '.')[i + 1:], '.'))) AS pattern FROM u WHERE host <> ''
    UNION ALL SELECT uid, fetched_at, unnest(list_transform(range(1, least(len(seg), 2) + 1),
      lambda i: host || '/' || array_to_string(seg[1:i], '/'))) FROM u WHERE host <> '')),
p AS (SELECT DISTINCT pattern, CAST('0x' || substr(md5('l' || pattern), 1, 8) AS BIGINT) AS h FROM asked),
ev AS (SELECT pattern, 1704067200 + h % 1728000 + 86400 * d AS ts, listed FROM p,
    (VALUES (0, true, 1), (4, false, 2), (9, true, 5)) AS st(d, listed, m) WHERE h % 3 = 0 AND h % m = 0),
ch AS (SELECT *, lag(listed) OVER (PARTITION BY pattern ORDER BY ts) AS was FROM ev),
iv AS (SELECT pattern, ts AS valid_from, listed, lead(ts) OVER (PARTITION BY pattern ORDER BY ts) AS valid_to
    FROM ch WHERE was IS NULL OR was <> listed),
hit AS (SELECT uid, count(*) AS n, max({'n': length(iv.pattern), 'pattern': iv.pattern, 'valid_from': valid_from}) AS best
    FROM asked JOIN iv ON asked.pattern = iv.pattern AND listed AND fetched_at >= valid_from AND (valid_to IS NULL OR fetched_at < valid_to) GROUP BY uid)
SELECT page_id, url, fetched_at, n IS NOT NULL AS blocked, coalesce(n, 0) AS n_entries, best.pattern AS pattern, best.valid_from AS listed_since
FROM u LEFT JOIN hit USING (uid)
"""
