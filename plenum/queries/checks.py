"""Joins against reference tables, set operations, classifiers and waterfalls."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plenum.functions import text
from plenum.operators import reference, report
from plenum.plans.tables import table

from .registry import query



@query("lookup_last_wins", "WITH l AS (SELECT s_nationkey, s_suppkey, s_name FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1) SELECT n_name, s_suppkey, s_name FROM nation LEFT JOIN l ON s_nationkey = n_nationkey")
def lookup_last_wins(spark, sf_dir):
    last = reference.last_wins(table(spark, sf_dir, "supplier"), ["s_nationkey"], "s_suppkey", "s_suppkey", "s_name")
    n = table(spark, sf_dir, "nation")
    return n.join(last, n.n_nationkey == last.s_nationkey, "left").select("n_name", "s_suppkey", "s_name")


@query("explode_lookup_concat", "WITH t AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS token, generate_subscripts(string_split(p_name, ' '), 1) AS pos FROM part), f AS (SELECT token, min(p_partkey) AS first FROM t GROUP BY token) SELECT p_partkey, string_agg(first::VARCHAR, ' / ' ORDER BY pos) AS firsts FROM t JOIN f USING (token) GROUP BY p_partkey")
def explode_lookup_concat(spark, sf_dir):
    t = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("pos", "token"))
    f = t.groupBy("token").agg(F.min("p_partkey").alias("first"))
    items = F.array_sort(F.collect_list(F.struct("pos", "first")))
    return t.join(f, "token").groupBy("p_partkey").agg(F.array_join(F.transform(items, lambda x: x["first"].cast("string")), " / ").alias("firsts"))


WORDS = ("the", "der", "les", "que", "and")


@query("array_contains_join", f"WITH w AS (SELECT unnest({list(WORDS)}) AS word, generate_subscripts({list(WORDS)}, 1) - 1 AS pos), t AS (SELECT doc_id, list_distinct(string_split(lower(text), ' ')) AS items FROM documents) SELECT doc_id, min_by(word, pos) AS word, count(*) AS n FROM t JOIN w ON list_contains(items, word) GROUP BY doc_id")
def array_contains_join(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_intersect(F.array(*map(F.lit, WORDS)), F.split(F.lower("text"), " "))).alias("word"))
    place = F.array_position(F.array(*map(F.lit, WORDS)), F.col("word"))
    return d.groupBy("doc_id").agg(F.min_by("word", place).alias("word"), F.count("*").alias("n"))


@query("ghost_anti_join", "SELECT p_partkey, 'part ' || p_partkey || ' is on no order' AS warning FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45 AND l_partkey IS NOT NULL) AND EXISTS (SELECT 1 FROM lineitem WHERE l_quantity > 45)")
def ghost_anti_join(spark, sf_dir):
    valid = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    found = reference.ghosts(table(spark, sf_dir, "part").select("p_partkey"), valid, "p_partkey")
    return found.select("p_partkey", F.format_string("part %d is on no order", "p_partkey").alias("warning"))


@query("existence_three_valued", "SELECT doc_id, CASE WHEN quality = 1 THEN 'exists' WHEN quality = 0 THEN 'missing' ELSE 'unknown' END AS status FROM documents LEFT JOIN labels USING (doc_id)")
def existence_three_valued(spark, sf_dir):
    known = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("ok"))
    return reference.existence(table(spark, sf_dir, "documents").select("doc_id"), known, "doc_id", "ok")


@query("set_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def set_difference(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, sf_dir, "orders").where("o_totalprice > 300000").select("o_custkey"))


@query("set_intersection", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_totalprice > 300000")
def set_intersection(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).intersect(table(spark, sf_dir, "orders").where("o_totalprice > 300000").select("o_custkey"))


@query("set_union", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def set_union(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query("pending_queue", "SELECT c_custkey, count(o_orderkey) AS have FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey HAVING count(o_orderkey) < 10")
def pending_queue(spark, sf_dir):
    return reference.pending(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", 10)


@query("prefix_classifier", "SELECT p_partkey, NOT (starts_with(lower(p_type), 'eco') OR starts_with(lower(p_type), 'sta')) AS accepted FROM part")
def prefix_classifier(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", (~text.has_prefix(F.col("p_type"), ("eco", "sta"))).alias("accepted"))








@query("tail_match", "WITH c AS (SELECT c_custkey, right(c_name, 4) AS t FROM customer), s AS (SELECT right(s_name, 4) AS u, min(s_suppkey) AS leader, count(*) AS ties FROM supplier GROUP BY 1), m AS (SELECT *, (substr(t,1,1)=substr(u,1,1))::INT + (substr(t,2,1)=substr(u,2,1))::INT + (substr(t,3,1)=substr(u,3,1))::INT + (substr(t,4,1)=substr(u,4,1))::INT AS score FROM c CROSS JOIN s) SELECT c_custkey, max(score)::BIGINT AS score, count(*) FILTER (score = top) AS ties, min(leader) FILTER (score = top) AS leader FROM (SELECT *, max(score) OVER (PARTITION BY c_custkey) AS top FROM m) GROUP BY c_custkey")
def tail_match(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.right("c_name", F.lit(4)).alias("t"))
    # candidates of the SQL are distinct tails, so each counts once
    s = table(spark, sf_dir, "supplier").groupBy(F.right("s_name", F.lit(4)).alias("u")).agg(F.min("s_suppkey").alias("leader"))
    best = reference.closest(c, s, "t", "u", "leader", 4)
    return c.join(best, "t").select("c_custkey", "score", "ties", "leader")


@query("ranked_selection", "WITH r AS (SELECT *, CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 1 WHEN l_discount = 0.1 THEN 2 WHEN l_linestatus = 'O' THEN 3 ELSE 4 END AS rule FROM lineitem) SELECT l_orderkey, l_partkey, l_suppkey, rule::BIGINT AS rule, ['returned', 'cheap', 'open', 'none'][rule] AS reason FROM r QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY rule, l_extendedprice DESC, l_partkey, l_suppkey) = 1")
def ranked_selection(spark, sf_dir):
    rules = [((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40), "returned"), (F.col("l_discount") == 0.1, "cheap"), (F.col("l_linestatus") == "O", "open")]
    return reference.first_rule(table(spark, sf_dir, "lineitem"), ["l_orderkey"], rules, [-F.col("l_extendedprice"), F.col("l_partkey"), F.col("l_suppkey")], ["l_partkey", "l_suppkey"])





@query("tallies", "SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS large, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY event_type")
def tallies(spark, sf_dir):
    return report.tallies(table(spark, sf_dir, "events"), "event_type", large=F.col("value") > 50, failed=F.col("event_type") == "error")


@query("row_rank", "SELECT n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) AS place, lead(n_name) OVER (PARTITION BY n_regionkey ORDER BY n_name) AS following FROM nation")
def row_rank(spark, sf_dir):
    w = W.partitionBy("n_regionkey").orderBy("n_name")
    return table(spark, sf_dir, "nation").select("n_name", F.row_number().over(w).cast("long").alias("place"), F.lead("n_name").over(w).alias("following"))
