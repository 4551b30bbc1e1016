"""Votes over events: a week of a user is an entity, its events are the runs, event_id is their order."""

from __future__ import annotations

from pyspark.sql import functions as F

from plenum.operators import consensus
from plenum.plans.tables import table

from .registry import query

KEYS = ["user_id", "week"]
FIELDS = ["event_type", "part", "band"]

RUNS = """runs AS (SELECT user_id, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, event_id, event_type,
  (hour(ts) // 6)::VARCHAR AS part, (json_extract(props, '$.k')::BIGINT // 25)::VARCHAR AS band, hour(ts)::BIGINT AS hour FROM events)"""
LONG = """long AS (SELECT user_id, week, event_id, 'event_type' AS field, event_type AS value FROM runs UNION ALL
  SELECT user_id, week, event_id, 'part', part FROM runs UNION ALL SELECT user_id, week, event_id, 'band', band FROM runs),
votes AS (SELECT user_id, week, field, value, count(*) AS n, min(event_id) AS first FROM long GROUP BY ALL),
won AS (SELECT user_id, week, field, value AS winner, n AS votes FROM votes QUALIFY row_number() OVER (PARTITION BY user_id, week, field ORDER BY n DESC, first) = 1),
score AS (SELECT user_id, week, event_id, count(*) FILTER (value IS NOT DISTINCT FROM winner) AS score FROM long JOIN won USING (user_id, week, field) GROUP BY ALL),
best AS (SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY user_id, week ORDER BY score DESC, event_id) = 1)"""


def runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    hour = F.hour("ts")
    return e.select(
        "user_id",
        F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("week"),
        "event_id",
        "event_type",
        F.floor(hour / 6).cast("long").cast("string").alias("part"),
        F.floor(F.get_json_object("props", "$.k").cast("long") / 25).cast("long").cast("string").alias("band"),
        hour.cast("long").alias("hour"),
    )


@query("majority_vote", f"WITH {RUNS}, v AS (SELECT user_id, week, event_type, count(*) AS n, min(event_id) AS first FROM runs GROUP BY ALL) SELECT user_id, week, event_type AS winner, n AS votes, (sum(n) OVER (PARTITION BY user_id, week))::BIGINT AS voters FROM v QUALIFY row_number() OVER (PARTITION BY user_id, week ORDER BY n DESC, first) = 1")
def majority_vote(spark, sf_dir):
    return consensus.majority(runs(spark, sf_dir), KEYS, "event_type", "event_id")


@query("vote_histogram", "SELECT user_id, event_type AS value, count(*) AS n, min(event_id) AS first FROM events GROUP BY ALL")
def vote_histogram(spark, sf_dir):
    return consensus.votes(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("best_run", f"WITH {RUNS}, {LONG} SELECT user_id, week, event_id, score FROM best")
def best_run(spark, sf_dir):
    return consensus.best(runs(spark, sf_dir), KEYS, FIELDS, "event_id").select(*KEYS, "event_id", "score")


@query("vote_diff", f"WITH {RUNS}, {LONG} SELECT user_id, week, field, long.value AS best_value, winner AS majority_value, votes FROM best JOIN long USING (user_id, week, event_id) JOIN won USING (user_id, week, field) WHERE winner IS NOT NULL AND long.value IS DISTINCT FROM winner")
def vote_diff(spark, sf_dir):
    return consensus.differences(runs(spark, sf_dir), KEYS, FIELDS, "event_id")


@query("keyed_list_vote", f"WITH {RUNS}, v AS (SELECT user_id, week, hour, event_type, count(*) AS n, min(event_id) AS first FROM runs GROUP BY ALL) SELECT user_id, week, hour, row_number() OVER (PARTITION BY user_id, week ORDER BY hour) AS place, event_type AS winner, n AS votes FROM (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY user_id, week, hour ORDER BY n DESC, first) = 1)")
def keyed_list_vote(spark, sf_dir):
    from pyspark.sql import Window as W

    found = consensus.majority(runs(spark, sf_dir), [*KEYS, "hour"], "event_type", "event_id")
    return found.select(*KEYS, "hour", F.row_number().over(W.partitionBy(*KEYS).orderBy("hour")).cast("long").alias("place"), "winner", "votes")


@query("soft_field_exclusion", "WITH l AS (SELECT o_custkey, o_orderkey, 'o_orderstatus' AS field, o_orderstatus AS value FROM orders UNION ALL SELECT o_custkey, o_orderkey, 'year', year(o_orderdate)::VARCHAR FROM orders), v AS (SELECT o_custkey, field, value, count(*) AS n, min(o_orderkey) AS first FROM l GROUP BY ALL) SELECT o_custkey, field, value AS winner, n AS votes, (sum(n) OVER (PARTITION BY o_custkey, field))::BIGINT AS voters FROM v QUALIFY row_number() OVER (PARTITION BY o_custkey, field ORDER BY n DESC, first) = 1")
def soft_field_exclusion(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return consensus.winners(o, ["o_custkey"], ["o_orderstatus", "o_orderpriority", "year"], "o_orderkey", soft=("o_orderpriority",))


@query("candidate_merge", "WITH v AS (SELECT user_id, event_type AS value, count(*) AS n FROM events WHERE value > 50 GROUP BY user_id, event_type UNION ALL SELECT user_id, event_type, 0 FROM events GROUP BY ALL) SELECT user_id, value, sum(n)::BIGINT AS n, row_number() OVER (PARTITION BY user_id ORDER BY sum(n) DESC, value) AS place FROM v GROUP BY user_id, value".replace("WHERE value > 50", "WHERE events.value > 50"))
def candidate_merge(spark, sf_dir):
    from pyspark.sql import Window as W

    e = table(spark, sf_dir, "events").withColumnRenamed("value", "amount")
    cast = e.where("amount > 50").groupBy("user_id", F.col("event_type").alias("value")).agg(F.count("*").alias("n"))
    anchors = e.select("user_id", F.col("event_type").alias("value")).distinct()
    found = consensus.merged_candidates(cast, anchors, ["user_id"])
    return found.withColumn("place", F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("n"), "value")).cast("long"))


@query("topk_candidates", "SELECT user_id, event_type, n, place FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS place FROM events GROUP BY user_id, event_type) WHERE place <= 3")
def topk_candidates(spark, sf_dir):
    from pyspark.sql import Window as W

    n = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("n"), "event_type")).cast("long")).where("place <= 3")


@query("ordered_distinct", "SELECT user_id, string_agg(event_type, ', ' ORDER BY first) AS seen FROM (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY ALL) GROUP BY user_id")
def ordered_distinct(spark, sf_dir):
    found = consensus.first_seen(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")
    return found.select("user_id", F.array_join("seen", ", ").alias("seen"))


@query("latest_status", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_status(spark, sf_dir):
    from plenum.operators.reference import latest

    return latest(table(spark, sf_dir, "events"), "user_id", F.struct("ts", "event_id"), "event_id", "event_type")
