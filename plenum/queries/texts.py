"""Intervals, findings, scalar functions and fan-out."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plenum.functions import text
from plenum.operators import intervals, report
from plenum.plans.tables import table

from .registry import query

SPANS = "spans AS (SELECT user_id, floor(epoch(ts))::BIGINT AS b, floor(epoch(ts))::BIGINT + floor(value * 60)::BIGINT AS e FROM events)"
MERGED = """marked AS (SELECT *, CASE WHEN b > max(e) OVER w THEN 1 WHEN max(e) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM spans WINDOW w AS (PARTITION BY user_id ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM marked),
merged AS (SELECT user_id, min(b) AS b, max(e) AS e, count(*) AS parts FROM numbered GROUP BY user_id, island)"""
DAYS = "days AS (SELECT DISTINCT user_id, epoch(date_trunc('day', ts))::BIGINT + 28800 AS s, epoch(date_trunc('day', ts))::BIGINT + 64799 AS t FROM events)"


def seconds(c):
    return F.unix_seconds(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))


def spans(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", seconds("ts").alias("b"), (seconds("ts") + F.floor(F.col("value") * 60).cast("long")).alias("e"))


def days(spark, sf_dir):
    day = seconds(F.date_trunc("day", "ts"))
    return table(spark, sf_dir, "events").select("user_id", (day + 28800).alias("s"), (day + 64799).alias("t")).distinct()


@query("interval_merge", f"WITH {SPANS}, {MERGED} SELECT * FROM merged")
def interval_merge(spark, sf_dir):
    return intervals.merge(spans(spark, sf_dir), ["user_id"], "b", "e")


@query("interval_overlap", f"WITH {SPANS}, {DAYS} SELECT user_id, b, e, s, t, least(e, t) - greatest(b, s) + 1 AS shared FROM spans JOIN days USING (user_id) WHERE b <= t AND e >= s")
def interval_overlap(spark, sf_dir):
    return intervals.overlap(spans(spark, sf_dir), days(spark, sf_dir), ["user_id"], 86_400)


@query("coverage_ratio", f"WITH {SPANS}, {MERGED}, {DAYS}, c AS (SELECT user_id, s, t, sum(least(e, t) - greatest(b, s) + 1)::BIGINT AS covered FROM merged JOIN days USING (user_id) WHERE b <= t AND e >= s GROUP BY ALL) SELECT user_id, s, t, coalesce(covered, 0) AS covered, round(coalesce(covered, 0) / (t - s + 1), 6) AS ratio, coalesce(covered, 0) / (t - s + 1) >= 0.1 AS enough FROM days LEFT JOIN c USING (user_id, s, t)")
def coverage_ratio(spark, sf_dir):
    return intervals.coverage(spans(spark, sf_dir), days(spark, sf_dir), ["user_id"], 86_400, 0.1)


@query("rate_window", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY floor(epoch(ts))::BIGINT RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS recent FROM events")
def rate_window(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("s", seconds("ts"))
    return e.select("event_id", F.count("*").over(W.partitionBy("user_id").orderBy("s").rangeBetween(-3600, 0)).alias("recent"))




FOUND = """found AS (
  SELECT 'critical' AS bucket, 'orders[' || o_orderkey || '].price' AS path, 'HALLUCINATION ALERT at ''orders[' || o_orderkey || '].price'': too much' AS message FROM orders WHERE o_totalprice > 450000
  UNION ALL SELECT 'warning', 'customer.' || c_custkey, 'balance at ''customer.' || c_custkey || ''': below zero' FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'warning', 'orders[' || o_orderkey || '].status', 'state at ''orders[' || o_orderkey || '].status'': open' FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 400000)"""


def found(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    price, state = F.format_string("orders[%d].price", "o_orderkey"), F.format_string("orders[%d].status", "o_orderkey")
    return report.findings(
        (o.where("o_totalprice > 450000"), "critical", price, "HALLUCINATION ALERT at '%s': too much"),
        (c.where("c_acctbal < 0"), "warning", F.format_string("customer.%d", "c_custkey"), "balance at '%s': below zero"),
        (o.where("o_orderstatus = 'P' AND o_totalprice > 400000"), "warning", state, "state at '%s': open"),
    )


@query("findings_union", f"WITH {FOUND} SELECT * FROM found")
def findings_union(spark, sf_dir):
    return found(spark, sf_dir)


@query("warning_parse", rf"WITH {FOUND} SELECT message, regexp_extract(message, '''([^'']*)''', 1) AS path, contains(message, 'HALLUCINATION') AS invented, try_cast(regexp_extract(message, '\[(\d+)\]', 1) AS BIGINT) AS index FROM found")
def warning_parse(spark, sf_dir):
    return report.parsed(found(spark, sf_dir).select("message"))


@query("impact", rf"WITH {FOUND}, p AS (SELECT *, regexp_extract(path, '^([^.\[]*)', 1) AS block, regexp_extract(path, '\[(\d+)\]', 1) AS i FROM found) SELECT block, count(*) FILTER (bucket = 'critical') AS fatal, count(DISTINCT CASE WHEN i <> '' THEN i END) AS indices, CASE WHEN bool_or(bucket = 'critical') THEN 'DELETE_BLOCK' ELSE 'CLEAN_ENTRIES' END AS action FROM p GROUP BY block")
def impact(spark, sf_dir):
    return report.impact(found(spark, sf_dir))



@query("text_clean", "SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> ''), ' ')) AS cleaned FROM documents")
def text_clean(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.clean_lines(F.col("text")).cast("binary")).alias("cleaned"))



@query("line_list", "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents), k AS (SELECT upper(replace(trim(line, ' '), 'ß', 'SS')) AS id, min((doc_id * 100000) + pos) AS first FROM l WHERE trim(line, ' ') <> '' AND NOT starts_with(trim(line, ' '), '#') GROUP BY 1) SELECT md5(id) AS id, first FROM k")
def line_list(spark, sf_dir):
    from plenum.sources.files import line_list as scan

    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line"))
    ids = scan(d.select("line", (F.col("doc_id") * 100000 + F.col("p") + 1).alias("pos")))
    return ids.select(F.md5(F.col("id").cast("binary")).alias("id"), F.col("pos").alias("first"))



@query("display_truncate", "WITH s AS (SELECT c_nationkey, list(c_custkey::VARCHAR ORDER BY c_custkey) AS l FROM customer GROUP BY 1) SELECT c_nationkey, array_to_string(CASE WHEN len(l) > 3 THEN list_append(l[:3], '... (' || (len(l) - 3) || ' more)') ELSE l END, ', ') AS shown FROM s")
def display_truncate(spark, sf_dir):
    from plenum.operators.report import first_items

    return first_items(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey", 3).withColumnRenamed("items", "shown")



@query("label_translate", "SELECT p_partkey, string_agg(CASE x WHEN 'red' THEN 'R' WHEN 'small' THEN 'S' ELSE x END, ', ' ORDER BY pos) AS labels FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS x, generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part) GROUP BY p_partkey")
def label_translate(spark, sf_dir):
    names = F.create_map(F.lit("red"), F.lit("R"), F.lit("small"), F.lit("S"))
    return table(spark, sf_dir, "part").select("p_partkey", text.translated(F.regexp_replace("p_name", " ", ","), names).alias("labels"))


@query("release_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS released, upper(substr(o_orderpriority, 3, 1)) || lower(substr(o_orderpriority, 4)) AS state FROM orders")
def release_date(spark, sf_dir):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    cut = F.coalesce(F.date_format(F.try_to_date(F.substring_index(iso, "T", 1), "yyyy-MM-dd"), "yyyy-MM-dd"), F.substring(iso, 1, 10))
    return table(spark, sf_dir, "orders").select("o_orderkey", cut.alias("released"), text.capitalized(F.substring("o_orderpriority", 3, 1 << 30)).alias("state"))


@query("sanitized_values", "SELECT doc_id, coalesce(trim(quality::VARCHAR, ' '), '') AS quality, quality IS NULL OR lower(trim(lang, ' ')) IN ('none', 'n/a', 'null', '', '-') AS empty FROM documents LEFT JOIN labels USING (doc_id)")
def sanitized_values(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", text.sanitized(F.col("quality")).alias("quality"), (F.col("quality").isNull() | text.is_empty(F.col("lang"))).alias("empty"))
