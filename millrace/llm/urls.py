"""URL filter: a temporal join of captures with dated block and allow lists.

List entries are events: from ``day`` on, ``pattern`` is blocked or allowed
within its scope.  ``validity`` turns the events of a pattern into intervals,
each ending where the next begins; ``filter_urls`` asks for every capture which
interval was active on the day it was fetched, so later changes of a list never
reach back.

A capture looks up its path prefixes (scope ``path``), its host (``host``) and
every parent domain of two or more labels, its host included (``domain``).  Of
the active entries the most specific decides: path before host before domain,
and the longer pattern within a scope.  Captures join intervals on the pattern
and on a block of ``SPAN`` days, so a pattern with a long history, or one that
a third of all captures share, is an equality join that can be split.

Defined cases: a null or unparsable URL has no patterns and is kept, as is a
capture without a day (none is active then); events with a null field are
ignored; of events of one pattern on one day, block wins; repeated captures are
judged each; an empty list keeps everything; an empty table gives an empty
result; other columns are carried unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded_broadcast, materialize, table

SCOPES = ("domain", "host", "path")
SPAN = 64
FOREVER = 1 << 30

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def validity(events: DataFrame) -> DataFrame:
    """Events (scope, pattern, blocked, day) -> intervals (scope, pattern, blocked, first_day, end_day), the end exclusive."""
    known = events.where("scope is not null and pattern is not null and blocked is not null and day is not null")
    daily = known.groupBy("scope", "pattern", F.col("day").cast("int").alias("first_day")).agg(F.max("blocked").alias("blocked"))
    later = Window.partitionBy("scope", "pattern").orderBy("first_day")
    return daily.withColumn("end_day", F.coalesce(F.lead("first_day").over(later), F.lit(FOREVER)))


def patterns(url: Column) -> Column:
    """Array of (scope number, pattern) that an entry for this URL could have."""
    name = host(url)
    labels = F.split(name, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(labels) - 1)),
                          lambda i: F.struct(F.lit(0).alias("scope_no"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    steps = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    paths = F.transform(steps, lambda s, i: F.struct(
        F.lit(2).alias("scope_no"), F.concat(name, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i + 1), "/")).alias("pattern")))
    own = F.array(F.struct(F.lit(1).alias("scope_no"), name.alias("pattern")))
    return F.when(name != "", F.concat(parents, own, paths))


def filter_urls(captures: DataFrame, events: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """``captures`` with url_blocked, and the scope, pattern and first day of the entry that decided (null if none)."""
    columns = captures.columns
    intervals = validity(events)
    last = F.lit(FOREVER // SPAN)
    # an interval is filed under each span of days it touches; open ones once, under the span FOREVER
    filed = (intervals
             .withColumn("until", F.when(F.col("end_day") == FOREVER, F.col("first_day")).otherwise(F.col("end_day") - 1))
             .withColumn("span", F.explode(F.when(F.col("end_day") == FOREVER, F.array(last)).otherwise(
                 F.sequence(F.floor(F.col("first_day") / SPAN).cast("int"), F.floor(F.col("until") / SPAN).cast("int")))))
             .select(F.array_position(F.array(*map(F.lit, SCOPES)), F.col("scope")).cast("int").alias("scope_at"),
                     F.col("pattern").alias("listed"), "span", "blocked", "first_day", "end_day"))
    filed = bounded_broadcast(materialize(filed, "url-intervals"))
    # a capture looks under its own span and under FOREVER
    asked = (captures.select(F.struct(*columns).alias("row"), F.monotonically_increasing_id().alias("row_no"))
             .withColumn("at", F.col(f"row.{day}").cast("int"))
             .withColumn("place", F.explode_outer(patterns(F.col(f"row.{url}"))))
             .withColumn("asked_span", F.explode(F.array(F.floor(F.col("at") / SPAN).cast("int"), last))))
    active = asked.join(filed, (F.col("place.pattern") == F.col("listed")) & (F.col("place.scope_no") + 1 == F.col("scope_at"))
                        & (F.col("asked_span") == F.col("span")) & (F.col("first_day") <= F.col("at")) & (F.col("at") < F.col("end_day")), "left")
    entry = F.when(F.col("listed").isNotNull(), F.struct("scope_at", F.length("listed").alias("size"), "listed", "blocked", "first_day"))
    judged = active.groupBy("row_no").agg(F.first("row").alias("row"), F.max(entry).alias("entry"))
    scope = F.when(F.col("entry").isNotNull(), F.element_at(F.array(*map(F.lit, SCOPES)), F.col("entry.scope_at")))
    return judged.select(*(F.col(f"row.{c}").alias(c) for c in columns), F.coalesce(F.col("entry.blocked"), F.lit(False)).alias("url_blocked"),
                         scope.alias("url_scope"), F.col("entry.listed").alias("url_pattern"), F.col("entry.first_day").alias("url_listed_on"))


# -- the query: lists and fetch days that Spark derives from the pages ---------

#: Words in a host name that the list blocks from the first day on.
BAD_WORDS = "spam|pills|casino"


def _number(kind: str, value: Column) -> Column:
    """A number from 0 to 2**28 - 1 that the value decides."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(kind + ":"), value)), 1, 7), 16, 10).cast("int")


def derived_events(pages: DataFrame) -> DataFrame:
    """A list for the hosts in the table: some are blocked and later allowed again, some domains and paths have entries of their own."""
    hosts = pages.select(host(F.col("url")).alias("host")).where("host != ''").distinct()
    h = F.col("host")
    domain = F.regexp_extract(h, r"([^.]+\.[^.]+\.[^.]+)$", 1)

    def event(scope: str, pattern: Column, blocked: bool, day: Column) -> Column:
        return F.struct(F.lit(scope).alias("scope"), pattern.alias("pattern"), F.lit(blocked).alias("blocked"), day.cast("int").alias("day"))

    listed = F.pmod(_number("day", h), F.lit(200))
    events = F.array(
        F.when(h.rlike(BAD_WORDS), event("host", h, True, F.lit(0))),
        F.when(_number("host", h) % 4 == 0, event("host", h, True, listed)),
        F.when(_number("host", h) % 4 == 0, event("host", h, False, listed + 30 + _number("stay", h) % 60)),
        F.when((domain != "") & (_number("domain", domain) % 5 == 0), event("domain", domain, True, F.pmod(_number("day", domain), F.lit(300)))),
        F.when(_number("path", h) % 3 == 0, event("path", F.concat(h, F.lit("/en")), False, listed + 10)))
    return hosts.select(F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e")).select("e.*").distinct()


ORACLE = """
WITH p AS (
  SELECT page_id, url, (page_id % 365)::INTEGER AS day,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM pages),
h AS (
  SELECT DISTINCT host, regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) AS domain FROM p WHERE host <> ''),
n AS (
  SELECT *, ('0x' || substr(md5('host:' || host), 1, 7))::INTEGER AS nh, ('0x' || substr(md5('day:' || host), 1, 7))::INTEGER % 200 AS d,
         ('0x' || substr(md5('stay:' || host), 1, 7))::INTEGER % 60 AS stay, ('0x' || substr(md5('path:' || host), 1, 7))::INTEGER AS np,
         ('0x' || substr(md5('domain:' || domain), 1, 7))::INTEGER AS nd, ('0x' || substr(md5('day:' || domain), 1, 7))::INTEGER % 300 AS dd FROM h),
e AS (
  SELECT 'host' AS scope, host AS pattern, true AS blocked, 0 AS day FROM n WHERE regexp_matches(host, 'spam|pills|casino')
  UNION SELECT 'host', host, true, d FROM n WHERE nh % 4 = 0
  UNION SELECT 'host', host, false, d + 30 + stay FROM n WHERE nh % 4 = 0
  UNION SELECT 'domain', domain, true, dd FROM n WHERE domain <> '' AND nd % 5 = 0
  UNION SELECT 'path', host || '/en', false, d + 10 FROM n WHERE np % 3 = 0),
i AS (
  SELECT scope, pattern, day AS first_day, bool_or(blocked) AS blocked,
         coalesce(lead(day) OVER (PARTITION BY scope, pattern ORDER BY day), 1073741824) AS end_day FROM e GROUP BY scope, pattern, day),
m AS (
  SELECT p.page_id, p.url, p.day, i.scope, i.pattern, i.blocked, i.first_day,
         row_number() OVER (PARTITION BY p.page_id ORDER BY CASE i.scope WHEN 'path' THEN 0 WHEN 'host' THEN 1 WHEN 'domain' THEN 2 ELSE 3 END,
                            length(i.pattern) DESC) AS best
  FROM p LEFT JOIN i ON p.day >= i.first_day AND p.day < i.end_day AND (
       (i.scope = 'host' AND i.pattern = p.host) OR (i.scope = 'domain' AND (p.host = i.pattern OR ends_with(p.host, '.' || i.pattern)))
    OR (i.scope = 'path' AND (p.host || rtrim(p.path, '/') = i.pattern OR starts_with(p.host || p.path, i.pattern || '/')))))
SELECT page_id, url, day, coalesce(blocked, false) AS url_blocked, scope AS url_scope, pattern AS url_pattern, first_day AS url_listed_on
FROM m WHERE best = 1
"""


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """Which pages were on a block list on the day they were fetched (a day of the year that the page's id decides)."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    captures = pages.withColumn("day", F.pmod(F.col("page_id"), F.lit(365)).cast("int"))
    return filter_urls(captures, derived_events(pages))
