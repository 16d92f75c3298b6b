"""URL filters with a history: dated list entries joined to captures as of their fetch time.

A list is a table of dated changes (entry, added, at). An entry is a domain, which covers its
subdomains, or a domain with leading path segments. Changes become validity intervals [since, until);
a capture looks up its host's suffixes of two labels or more and its path prefixes, as deep as the
deepest entry of the list.
The as-of join puts an entry's interval starts and the times at which captures ask for it into one order
and carries the last start forward: what it carries to a time is the interval that began last, and the
entry is active if that has not ended. The order is made within chunks of time, and chunks are tied by
one row each, so an entry that a third of all captures ask for is spread over its chunks. Captures of
the same key and time ask once. An interval is one row however long it is, so rows grow with changes
and captures only. All of it is DataFrame operations.

Defined cases: of changes at the same time a removal wins; repeated additions or removals change
nothing; changes with a null field or a blank entry are left out; a capture with a null time or
without a host is not listed; captures equal in id, url and time are one; of several active entries
the longest is named, of equally long ones the smaller; an interval includes its start and not its
end; empty tables are fine; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Path segments that OP7_SQL looks up (its entries have one at most); seconds of a chunk of an entry's history.
DEPTH, CHUNK = 2, 6 * 3600


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def url_segments(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def entry_depth(changes: DataFrame) -> int:
    """The most path segments of an entry."""
    return changes.agg(F.max(F.size(F.split("entry", "/")) - 1)).first()[0] or 0


def lookup_keys(url: Column, depth: int) -> Column:
    """All entries of up to ``depth`` path segments that would cover ``url``: domain suffixes, and the host with leading path segments."""
    host, segments = url_host(url), url_segments(url)
    labels = F.split(host, r"\.")
    suffixes = F.when(F.size(labels) >= 2, F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).otherwise(F.array(host))
    n = F.least(F.size(segments), F.lit(depth))
    prefixes = F.when(n >= 1, F.transform(
        F.sequence(F.lit(1), n), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, 1, i), "/")))) \
        .otherwise(F.array().cast("array<string>"))
    return F.when(F.length(host) > 0, F.array_distinct(F.concat(suffixes, prefixes)))


def slot(t: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(t) / (seconds * 1_000_000)).cast("long")


def intervals(changes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """entry, since, until (null: still valid): when each entry is on the list; ``changes`` is (entry, added, at).

    An entry's history is ordered within chunks of time, and chunks are tied by one row each, so that no
    task holds the whole history of an entry that changes all the time.
    """
    at_once = (changes.select("entry", "added", F.col("at").cast("timestamp").alias("at"))
               .where("entry is not null and trim(entry) <> '' and added is not null and at is not null")
               .groupBy("entry", "at").agg(F.min("added").alias("added")).withColumn("chunk", slot(F.col("at"), chunk)))
    within, across = Window.partitionBy("entry", "chunk").orderBy("at"), Window.partitionBy("entry").orderBy("chunk")
    ends = at_once.groupBy("entry", "chunk").agg(F.max_by("added", "at").alias("_last"))
    ends = ends.select("entry", "chunk", F.lag("_last").over(across).alias("_earlier"))
    turns = (at_once.withColumn("_lag", F.lag("added").over(within)).join(ends, ["entry", "chunk"])
             .where("added <> coalesce(_lag, _earlier, false)").select("entry", "chunk", "at", "added"))
    firsts = turns.groupBy("entry", "chunk").agg(F.min("at").alias("_first"))
    firsts = firsts.select("entry", "chunk", F.lead("_first").over(across).alias("_later"))
    return (turns.withColumn("_lead", F.lead("at").over(within)).join(firsts, ["entry", "chunk"]).where("added")
            .select("entry", F.col("at").alias("since"), F.coalesce("_lead", "_later").alias("until")))


def as_of(asked: DataFrame, spans: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """entry, at and since of the ``asked`` (entry, at) that an interval of ``spans`` (entry, since, until) holds."""
    starts = spans.select("entry", F.col("since").alias("at"), F.struct("since", "until").alias("span"))
    line = starts.unionByName(asked.select("entry", "at").distinct(), allowMissingColumns=True)
    line = line.withColumn("chunk", slot(F.col("at"), chunk))
    # the last start up to a time in its chunk (starts come first at equal times), else that of an earlier chunk
    within = Window.partitionBy("entry", "chunk").orderBy("at", F.col("span").isNull())
    before = Window.partitionBy("entry").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = line.groupBy("entry", "chunk").agg(F.max("span").alias("_end"))
    ends = ends.select("entry", "chunk", F.last("_end", ignorenulls=True).over(before).alias("_earlier"))
    last = line.withColumn("_last", F.last("span", ignorenulls=True).over(within)).where("span is null").drop("span")
    found = last.join(ends, ["entry", "chunk"]).select("entry", "at", F.coalesce("_last", "_earlier").alias("s"))
    return found.where("s.until is null or at < s.until").where("s is not null").select("entry", "at", F.col("s.since").alias("since"))


def judge(captures: DataFrame, changes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """page_id, url, fetched_at, listed, n_entries, entry and since of each different capture."""
    common.prepare(captures.sparkSession)
    captures = captures.select("page_id", "url", F.col("fetched_at").cast("timestamp").alias("fetched_at")).distinct()
    changes = common.written(changes.select("entry", "added", F.col("at").cast("timestamp").alias("at")), "changes")
    looked = (captures.where("fetched_at is not null")
              .select("page_id", "url", "fetched_at", F.explode(lookup_keys(F.col("url"), entry_depth(changes))).alias("entry")))
    asked = looked.select("entry", F.col("fetched_at").alias("at")).join(changes.select("entry").distinct(), "entry", "left_semi")
    active = looked.join(as_of(asked, intervals(changes, chunk), chunk).withColumnRenamed("at", "fetched_at"), ["entry", "fetched_at"])
    named = F.min_by(F.struct("entry", "since"), F.struct(-F.length("entry"), F.col("entry")))
    found = active.groupBy("page_id", "url", "fetched_at").agg(F.count(F.lit(1)).alias("n_entries"), named.alias("_top"))
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"f.{k}")) for k in ("page_id", "url", "fetched_at")]
    out = captures.alias("c").join(found.alias("f"), same[0] & same[1] & same[2], "left")
    return out.select("c.page_id", "c.url", "c.fetched_at", F.col("n_entries").isNotNull().alias("listed"),
                      F.coalesce("n_entries", F.lit(0).cast("long")).alias("n_entries"),
                      F.col("_top.entry").alias("entry"), F.col("_top.since").alias("since"))


def op7_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against a list whose changes are dated by events.

    A page is taken as fetched at a time that its id gives, within the month of the events. Every error
    and purchase event adds (error) or removes (purchase) the host, the domain or the first path of the
    page that its number gives modulo the number of pages.
    """
    pages = common.read(spark, sf_dir, "pages").select("page_id", "url")
    at = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(2592000)))
    host, first = url_host(F.col("url")), F.coalesce(F.get(url_segments(F.col("url")), 0), F.lit(""))
    labels = F.split(host, r"\.")
    kind = F.pmod("user_id", F.lit(3))
    entry = F.when(kind == 0, host).when(kind == 1, F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")) \
             .otherwise(F.concat(host, F.lit("/"), first))
    events = common.read(spark, sf_dir, "events").where("event_type in ('error', 'purchase')")
    dealt = events.withColumn("page_id", F.pmod("event_id", F.lit(max(1, pages.count()))))
    changes = dealt.join(pages, "page_id").select(
        entry.alias("entry"), (F.col("event_type") == "error").alias("added"), F.col("ts").alias("at"))
    found = judge(pages.withColumn("fetched_at", at), changes)
    return found.select("page_id", "url", F.unix_micros("fetched_at").alias("fetched_us"), "listed", "n_entries",
                        "entry", F.unix_micros("since").alias("since_us"))


_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1))"
_PATH = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1)"
OP7_SQL = rf"""
WITH p AS (
  SELECT page_id, url, {_HOST} AS host, list_filter(string_split({_PATH}, '/'), lambda s: s <> '') AS seg,
         make_timestamp((1704067200 + (page_id * 7919) % 2592000) * 1000000) AS fetched_at FROM pages),
changes AS (
  SELECT CASE user_id % 3 WHEN 0 THEN host WHEN 1 THEN regexp_extract(host, '([^.]+\.)?[^.]+$')
              ELSE host || '/' || coalesce(seg[1], '') END AS entry, event_type = 'error' AS added, ts AS changed
  FROM events JOIN p ON page_id = event_id % (SELECT count(*) FROM pages) WHERE event_type IN ('error', 'purchase')),
once AS (SELECT entry, changed, bool_and(added) AS added FROM changes
         WHERE trim(entry) <> '' AND changed IS NOT NULL GROUP BY entry, changed),
turns AS (SELECT entry, changed, added FROM once
          QUALIFY added <> coalesce(lag(added) OVER (PARTITION BY entry ORDER BY changed), false)),
caps AS (SELECT DISTINCT page_id, url, fetched_at, host, seg FROM p),
keys AS (
  SELECT page_id, url, fetched_at, unnest(list_distinct(list_concat(
           CASE WHEN contains(host, '.') THEN list_transform(range(1, len(string_split(host, '.'))),
                  lambda i: array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.'))
                ELSE [host] END,
           list_transform(range(1, least(len(seg), {DEPTH}) + 1), lambda i: host || '/' || array_to_string(seg[1:i], '/'))))) AS entry
  FROM caps WHERE host <> ''),
hits AS (
  SELECT k.page_id, k.url, k.fetched_at, k.entry, t.changed AS since
  FROM keys k ASOF JOIN turns t ON k.entry = t.entry AND k.fetched_at >= t.changed WHERE t.added),
found AS (
  SELECT page_id, url, fetched_at, count(*) AS n_entries,
         arg_min(entry, (-length(entry), entry)) AS entry, arg_min(since, (-length(entry), entry)) AS since
  FROM hits GROUP BY page_id, url, fetched_at)
SELECT c.page_id, c.url, epoch_us(c.fetched_at) AS fetched_us, f.n_entries IS NOT NULL AS listed,
       coalesce(f.n_entries, 0) AS n_entries, f.entry, epoch_us(f.since) AS since_us
FROM caps c LEFT JOIN found f ON c.page_id IS NOT DISTINCT FROM f.page_id
  AND c.url IS NOT DISTINCT FROM f.url AND c.fetched_at IS NOT DISTINCT FROM f.fetched_at
"""
