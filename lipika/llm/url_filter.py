"""URL filters: a temporal list join.

List entries are dated: from one moment on a list has a host, a path beginning or a whole
URL, from another it has not. Each entry's dates become a timeline of validity intervals, one row
for each list entry, and every capture looks up, as of its fetch time, the entries that
its URL can match: its host and the host's parent domains, the beginnings of its path at
slashes, and itself.

The captures' keys meet the timelines in an equi-join. A hot host repeats one key for very
many captures, so captures are first made distinct and both sides are salted; a capture
meets one row for each list and key, however often the entry changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.llm._common import columns_of, fresh, table

#: Copies of each timeline, among which the captures of one key are spread.
SALTS = 16


def normalised(url: Column) -> Column:
    """A URL without scheme, user, port, fragment and a slash at the end, the host in lower case; null stays null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*", 0), r"^.*@", ""), r"(:[0-9]*|\.)$", ""))
    rest = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*(.*)$", 1), r"/+$", "")
    return F.concat(host, rest)


def timelines(entries: DataFrame) -> DataFrame:
    """One row ``list, kind, value, changes`` for each entry of ``entries``.

    ``entries`` has ``list, kind, value, at, listed``: from ``at`` on the list has the entry
    (``listed``) or not. ``changes`` is the sorted array of ``(at, listed)``; an interval goes
    from a change up to, and without, the next. Of several changes at one moment the one
    that lists wins. Rows with a null are no changes. The array is as long as one entry has changes.
    """
    known = entries.where("list is not null and kind is not null and value is not null and at is not null and listed is not null")
    at_once = known.groupBy("list", "kind", "value", "at").agg(F.max("listed").alias("listed"))
    return at_once.groupBy("list", "kind", "value").agg(F.array_sort(F.collect_list(F.struct("at", "listed"))).alias("changes"))


def keys(url: Column) -> Column:
    """All ``(kind, value)`` that a normalised URL can match."""
    host = F.regexp_extract(url, r"^[^/?]*", 0)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("value")))
    path = F.regexp_extract(url, r"^[^?]*", 0)
    parts = F.split(path, "/")
    begins = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(F.lit("prefix").alias("kind"), F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")).alias("value")))
    return F.concat(domains, begins, F.array(F.struct(F.lit("url").alias("kind"), url.alias("value"))))


def evaluate(captures: DataFrame, entries: DataFrame, salts: int = SALTS) -> DataFrame:
    """What the lists held of each capture when it was fetched.

    ``captures`` has ``url, fetched_at`` and any other columns, which come back unchanged
    (one named ``hits`` is replaced). Adds ``hits``: the sorted array of
    ``list:kind:value`` of all entries valid then, empty if none. Every row comes back once.
    A null url or fetch time hits nothing; an empty list table leaves all hits empty.
    """
    fetched = captures.where("url is not null and fetched_at is not null").select(F.col("url").alias("uf_url"), F.col("fetched_at").alias("uf_at")).distinct()
    looked = fetched.withColumn("uf_key", F.explode(keys(normalised(F.col("uf_url"))))).select("uf_url", "uf_at", F.col("uf_key.kind").alias("kind"), F.col("uf_key.value").alias("value"))
    looked = looked.withColumn("uf_salt", F.pmod(F.xxhash64("uf_url", "uf_at"), F.lit(salts)))
    spread = timelines(entries).withColumn("uf_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    met = looked.join(spread, ["kind", "value", "uf_salt"])
    as_of = F.element_at(F.filter("changes", lambda c: c["at"] <= F.col("uf_at")), -1)["listed"]
    hits = met.where(F.exists("changes", lambda c: c["at"] <= F.col("uf_at"))).where(as_of).groupBy("uf_url", "uf_at").agg(F.array_sort(F.collect_set(F.concat_ws(":", "list", "kind", "value"))).alias("hits"))
    rest = captures.drop("hits")
    own_url, own_at = fresh(rest, "uf_url", "uf_at")
    hits = hits.withColumnsRenamed({"uf_url": own_url, "uf_at": own_at})
    out = rest.join(hits, (F.col("url") == F.col(own_url)) & (F.col("fetched_at") == F.col(own_at)), "left")
    return out.select(*columns_of(rest), F.coalesce("hits", F.array().cast("array<string>")).alias("hits"))


LISTS = ("malware", "phishing", "adult", "spam")
START, DAYS = "2024-01-01 00:00:00", 366


def _number(x: Column) -> Column:
    return F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long")


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages' captures. The table has no fetch times, so a page's url gives it one within a year."""
    second = _number(F.concat(F.lit("fetch/"), "url")) % (DAYS * 86400)
    return pages.select("page_id", "url", F.timestamp_seconds(F.unix_timestamp(F.lit(START).cast("timestamp")) + second).alias("fetched_at"))


def dated_feed(pages: DataFrame) -> DataFrame:
    """A feed of dated list changes about the pages' own hosts, domains, sections and urls.

    There is no list table, so digests decide: which lists ever have an entry, when it is
    first listed, when it is removed, and for some, when it is listed again.
    """
    url = normalised(F.col("url"))
    host = F.regexp_extract(url, r"^[^/?]*", 0)
    values = F.array(
        F.struct(F.lit("domain").alias("kind"), host.alias("value"), F.lit(4).alias("one_in")),
        F.struct(F.lit("domain").alias("kind"), F.regexp_extract(host, r"[^.]+\.[^.]+\.[^.]+$", 0).alias("value"), F.lit(6).alias("one_in")),
        F.struct(F.lit("prefix").alias("kind"), F.concat(F.regexp_extract(url, r"^[^/?]*/[^/?]*", 0), F.lit("/")).alias("value"), F.lit(5).alias("one_in")),
        F.struct(F.lit("url").alias("kind"), url.alias("value"), F.lit(40).alias("one_in")),
    )
    each = pages.where("url is not null").select(F.explode(values).alias("v")).select("v.*").where("value not in ('', '/')").distinct()
    each = each.withColumn("list", F.explode(F.array(*[F.lit(x) for x in LISTS]))).withColumn("name", F.concat_ws("|", "list", "kind", "value"))
    each = each.where(_number(F.col("name")) % F.col("one_in") == 0)
    day = lambda tag, within: _number(F.concat(F.lit(tag), "name")) % within
    first = day("a/", 250)
    gone = first + 1 + day("b/", 90)
    again = gone + 1 + day("c/", 90)
    changes = F.array(
        F.struct(first.alias("day"), F.lit(True).alias("listed")),
        F.struct(gone.alias("day"), F.lit(False).alias("listed")),
        F.struct(F.when(day("d/", 3) == 0, again).alias("day"), F.lit(True).alias("listed")),
    )
    rows = each.select("list", "kind", "value", F.explode(changes).alias("c")).where("c.day is not null")
    return rows.select("list", "kind", "value", F.timestamp_seconds(F.unix_timestamp(F.lit(START).cast("timestamp")) + F.col("c.day") * 86400).alias("at"), F.col("c.listed").alias("listed"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All captures against the entries active when they were fetched."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rows = evaluate(dated_captures(pages), dated_feed(pages))
    return rows.select("page_id", "url", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), (F.size("hits") > 0).alias("blocked"), F.size("hits").cast("long").alias("n_hits"), F.array_join("hits", ",").alias("hits"))


_N = "CAST('0x' || left(md5({}), 7) AS BIGINT)"
OP1_SQL = f"""
WITH p AS (SELECT page_id, url, TIMESTAMP '{START}' + to_seconds({_N.format("'fetch/' || url")} % {DAYS * 86400}) AS t,
  regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM pages),
u AS MATERIALIZED (SELECT page_id, url, t, lower(regexp_replace(regexp_replace(regexp_extract(bare, '^[^/?]*'), '^.*@', ''), '(:[0-9]*|\\.)$', ''))
  || regexp_replace(regexp_extract(bare, '^[^/?]*(.*)$', 1), '/+$', '') AS n FROM p),
v AS (SELECT DISTINCT kind, value, one_in FROM (
  SELECT 'domain' AS kind, regexp_extract(n, '^[^/?]*') AS value, 4 AS one_in FROM u UNION ALL
  SELECT 'domain', regexp_extract(regexp_extract(n, '^[^/?]*'), '[^.]+\\.[^.]+\\.[^.]+$'), 6 FROM u UNION ALL
  SELECT 'prefix', regexp_extract(n, '^[^/?]*/[^/?]*') || '/', 5 FROM u UNION ALL
  SELECT 'url', n, 40 FROM u) WHERE value NOT IN ('', '/')),
e AS (SELECT *, list || '|' || kind || '|' || value AS name FROM v, (SELECT unnest(['malware', 'phishing', 'adult', 'spam']) AS list)),
f AS (SELECT *, {_N.format("'a/' || name")} % 250 AS d1, {_N.format("'b/' || name")} % 90 + 1 AS d2, {_N.format("'c/' || name")} % 90 + 1 AS d3, {_N.format("'d/' || name")} % 3 = 0 AS twice
  FROM e WHERE {_N.format("name")} % one_in = 0),
g AS (SELECT DISTINCT list, kind, value, TIMESTAMP '{START}' + to_days(CAST(d1 AS INTEGER)) AS a, TIMESTAMP '{START}' + to_days(CAST(d1 + d2 AS INTEGER)) AS b FROM f
  UNION SELECT list, kind, value, TIMESTAMP '{START}' + to_days(CAST(d1 + d2 + d3 AS INTEGER)), TIMESTAMP '2999-01-01' FROM f WHERE twice),
h AS (SELECT DISTINCT url, t, list || ':' || kind || ':' || value AS hit FROM u JOIN g ON t >= a AND t < b AND
  ((kind = 'url' AND value = n) OR (kind = 'prefix' AND starts_with(regexp_extract(n, '^[^?]*') || '/', value)) OR (kind = 'domain' AND (regexp_extract(n, '^[^/?]*') = value OR ends_with(regexp_extract(n, '^[^/?]*'), '.' || value))))),
r AS (SELECT url, t, count(*) AS n_hits, string_agg(hit, ',' ORDER BY hit) AS hits FROM h GROUP BY url, t)
SELECT page_id, u.url, CAST(u.t AS VARCHAR) AS fetched_at, r.hits IS NOT NULL AS blocked, CAST(coalesce(n_hits, 0) AS BIGINT) AS n_hits, coalesce(hits, '') AS hits
FROM u LEFT JOIN r ON u.url = r.url AND u.t = r.t
"""

QUERIES = {"op1_url_filter": op1_url_filter}
ORACLES = {"op1_url_filter": OP1_SQL}
