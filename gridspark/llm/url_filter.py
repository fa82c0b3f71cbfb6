"""URL filters by a temporal list join [DataFrame functions only].

A list is a set of dated entries: a key (a domain or a path prefix), an action and the day it takes effect.
Entries of a key become validity intervals, each open until the key's next entry. A capture is looked up under
all keys it falls under, as of the day it was fetched; of the entries active then the most specific decides.

Captures are first reduced to distinct (deepest key, day) sites, so a host that a third of all captures share
costs one lookup a day. The as-of join meets on (key, month): no key has more rows in a month than days, on
either side. Decisions go back to captures by a join that keeps hot sites in place.

Keys: ``d:example.org`` is the domain and all below it; ``p:example.org/a/b/`` is that directory of exactly this
host. Path prefixes are more specific than domains, longer ones than shorter ones. Hosts are lower-cased (A-Z)
and lose a final dot; ports, users, queries and fragments do not count.

Cases: a URL that is null or has no scheme and host, or a capture without a day, falls under nothing: action
``allow`` without a rule. Entries with a null key, action or day are ignored. Entries of a key on the same day
count once: ``block`` before ``allow`` before ``remove``. ``remove`` ends an entry without another. Before its
first entry a key has none. Repeated captures get a decision each. Extra columns are carried.
"""

from __future__ import annotations

import json

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspark.llm.common import Run, join_hot, read

ACTIONS = ("remove", "allow", "block")  # by precedence on one day


def host_of(url: Column) -> Column:
    """The host of a URL, empty if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return F.translate(F.regexp_replace(host, r"\.$", ""), string.ascii_uppercase, string.ascii_lowercase)


def keys_of(url: Column) -> Column:
    """All keys a URL falls under, from its top domain to its deepest directory; empty without a host."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.size(labels), F.lit(1)), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    path = F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1)
    # Directories only: what follows the last slash is a page.
    steps = F.filter(F.split(F.regexp_extract(path, r"^(.*)/", 1), "/"), lambda s: s != "")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.size(steps)),
        lambda i: F.concat(F.lit("p:"), host, F.lit("/"), F.array_join(F.transform(F.slice(steps, F.lit(1), i), lambda s: F.concat(s, F.lit("/"))), "")))
    return F.when(host != "", F.concat(domains, prefixes)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, action, since, until): validity intervals of dated entries; ``until`` is exclusive, null if open."""
    rank = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    # One row per key and day at most, taken before the shuffle, so no key is large.
    daily = (
        entries.where(F.col("key").isNotNull() & F.col("since").isNotNull() & (rank > 0))
        .groupBy("key", F.col("since").cast("date").alias("since")).agg(F.max(rank).alias("rank"))
    )
    following = F.lead("since").over(Window.partitionBy("key").orderBy("since"))
    action = F.element_at(F.array(*map(F.lit, ACTIONS)), F.col("rank").cast("int"))
    return daily.select("key", action.alias("action"), "since", following.alias("until")).where("action <> 'remove'")


def decide(captures: DataFrame, entries: DataFrame, run: Run) -> DataFrame:
    """``captures`` (url, fetched_on and more) with action, rule and rule_since, in place of columns of these names."""
    captures = captures.drop("action", "rule", "rule_since")
    keys, day = keys_of(F.col("url")), F.col("fetched_on").cast("date")
    site = F.when(F.size(keys) > 0, F.concat_ws(" ", day.cast("string"), F.element_at(keys, -1)))
    placed = captures.withColumn("_site", F.when(day.isNotNull(), site))
    sites = run.write(
        placed.where(F.col("_site").isNotNull()).groupBy("_site").agg(
            F.first("url").alias("url"), F.first(day).alias("day"), F.count(F.lit(1)).alias("rows")),
        "sites",
    )
    lookups = sites.select("_site", "day", F.explode(keys).alias("key"))
    month = lambda d: F.trunc(d, "month")
    asked = run.write(lookups.select("key", "day").distinct().withColumn("month", month(F.col("day"))), "asked")
    # As texts, since a day may lie outside of what Python's dates hold.
    span = asked.agg(F.min("day").cast("string"), F.max("day").cast("string")).first()
    low, high = F.lit(span[0]).cast("date"), F.lit(span[1]).cast("date")
    # Only months that are asked for are looked at; the calendar has a few thousand at most.
    months = F.from_json(F.lit(json.dumps([r.month for r in asked.select(F.col("month").cast("string")).distinct().collect()])), "array<string>")
    valid = (
        intervals(entries).where((F.col("since") <= high) & (F.coalesce(F.col("until"), F.date_add(high, 1)) > low))
        .withColumn("month", F.explode(F.filter(F.transform(months, lambda m: m.cast("date")), lambda m: m.between(
            month(F.greatest("since", low)), month(F.least(F.date_sub(F.coalesce("until", F.date_add(high, 1)), 1), high))))))
    )
    active = asked.join(valid, ["key", "month"]).where(
        (F.col("since") <= F.col("day")) & (F.col("until").isNull() | (F.col("day") < F.col("until")))).select("key", "day", "action", "since")
    # A key starting with "p" is more specific than one starting with "d", then the longer one.
    rule = F.max(F.struct(F.substring("key", 1, 1).alias("kind"), F.length("key").alias("size"), "key", "action", "since")).alias("rule")
    decisions = run.write(
        lookups.join(active, ["key", "day"]).groupBy("_site").agg(rule).join(sites.select("_site", "rows"), "_site")
        .select("_site", "rows", F.col("rule.action").alias("action"), F.col("rule.key").alias("rule"), F.col("rule.since").alias("rule_since")),
        "decisions",
    )
    located = placed.where(F.col("_site").isNotNull())
    decided = join_hot(located, decisions, "_site", "rows", located.count())
    others = placed.join(decisions.select("_site").hint("merge"), "_site", "left_anti").withColumns(
        {"action": F.lit("allow"), "rule": F.lit(None).cast("string"), "rule_since": F.lit(None).cast("date")})
    columns = [*captures.columns, "action", "rule", "rule_since"]
    return decided.select(columns).unionByName(others.select(columns))


def _digit(text: Column, place: int) -> Column:
    """A number from 0 to 15 from the digest of a text."""
    return F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(text.cast("binary")), place, 1)) - 1


FIRST_DAY = "2024-01-01"


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``pages`` against a list of dated entries on their own hosts.

    The table has no days and no list, so both are derived from it: a page was fetched some days after the
    first day by its id, and each host and first directory has up to three entries by its digest.
    """
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("page_id") * 37 % 720).cast("int")))
    host = F.regexp_replace(host_of(F.col("url")), r"^(www|m|blog)\.", "")
    folder = F.regexp_extract("url", r"^[^:]+://[^/?#]*/([a-z]+)/", 1)
    places = pages.select(host_of(F.col("url")).alias("full"), host.alias("host"), folder.alias("folder")).where("host <> ''").distinct()
    turns = places.withColumn("turn", F.explode(F.array(*map(F.lit, range(3)))))
    seed = F.concat_ws(" ", "host", "folder", F.col("turn").cast("string"))
    kind = _digit(seed, 1)
    entries = turns.where(kind < 12).select(
        F.when((kind < 6) | (F.col("folder") == ""), F.concat(F.lit("d:"), "host")).otherwise(F.concat(F.lit("p:"), "full", F.lit("/"), "folder", F.lit("/"))).alias("key"),
        F.when(_digit(seed, 2) < 8, "block").when(_digit(seed, 2) < 12, "allow").otherwise("remove").alias("action"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), (_digit(seed, 3) * 16 + _digit(seed, 4) + F.col("turn") * 200).cast("int")).alias("since"),
    )
    return decide(captures, entries, Run(spark, "op4"))


OP4_SQL = r"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 720 AS INTEGER) AS fetched_on,
         lower(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.$', '')) AS full_host
  FROM pages
), places AS (
  SELECT DISTINCT full_host, regexp_replace(full_host, '^(www|m|blog)\.', '') AS host,
         regexp_extract(url, '^[^:]+://[^/?#]*/([a-z]+)/', 1) AS folder
  FROM captures WHERE full_host <> ''
), digits AS (
  SELECT full_host, host, folder, turn,
         list_transform([1, 2, 3, 4], lambda p: strpos('0123456789abcdef', md5(host || ' ' || folder || ' ' || turn)[p:p]) - 1) AS n
  FROM places, (SELECT unnest([0, 1, 2]) AS turn)
), entries AS (
  SELECT CASE WHEN n[1] < 6 OR folder = '' THEN 'd:' || host ELSE 'p:' || full_host || '/' || folder || '/' END AS key,
         CASE WHEN n[2] < 8 THEN 2 WHEN n[2] < 12 THEN 1 ELSE 0 END AS rank,
         DATE '2024-01-01' + CAST(n[3] * 16 + n[4] + turn * 200 AS INTEGER) AS since
  FROM digits WHERE n[1] < 12
), daily AS (
  SELECT key, since, max(rank) AS rank FROM entries GROUP BY key, since
), intervals AS (
  SELECT key, rank, since, lead(since) OVER (PARTITION BY key ORDER BY since) AS until FROM daily
), steps AS (
  SELECT page_id, url, fetched_on, full_host, string_split(full_host, '.') AS labels,
         list_filter(string_split(regexp_extract(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '^(.*)/', 1), '/'), lambda s: s <> '') AS dirs
  FROM captures WHERE full_host <> ''
), lookups AS (
  SELECT page_id, fetched_on, 'd:' || array_to_string(labels[i:], '.') AS key
  FROM (SELECT *, unnest(generate_series(1, len(labels))) AS i FROM steps)
  UNION ALL
  SELECT page_id, fetched_on, 'p:' || full_host || '/' || array_to_string(list_transform(dirs[1:i], lambda s: s || '/'), '') AS key
  FROM (SELECT *, unnest(generate_series(0, len(dirs))) AS i FROM steps)
), active AS (
  SELECT l.page_id, v.key, v.rank, v.since,
         row_number() OVER (PARTITION BY l.page_id ORDER BY v.key[1:1] DESC, length(v.key) DESC) AS n
  FROM lookups l JOIN intervals v ON l.key = v.key AND v.since <= l.fetched_on AND (v.until IS NULL OR l.fetched_on < v.until)
  WHERE v.rank > 0
)
SELECT c.page_id, c.url, c.fetched_on, CASE WHEN a.rank = 2 THEN 'block' ELSE 'allow' END AS action,
       a.key AS rule, a.since AS rule_since
FROM captures c LEFT JOIN active a ON a.page_id = c.page_id AND a.n = 1
"""
