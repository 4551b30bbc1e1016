"""Review decisions, corrections, fusions, papers and requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from plenum.operators import acquisition, review, structures
from plenum.plans.tables import table

from .registry import query

#: An order is a record: its state says where runs differ, its price which messages there are.
RECORD = """r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ligands[0].synonyms' WHEN 'O' THEN 'ligands[1].role' ELSE 'signaling_partners.note' END AS path,
  o_totalprice > 250000 AS critical, o_orderpriority IN ('1-URGENT', '2-HIGH') AS conflict FROM orders)"""


def records(spark, sf_dir):
    o, status, none = table(spark, sf_dir, "orders"), F.col("o_orderstatus"), F.array().cast("array<string>")
    path = F.when(status == "F", "ligands[0].synonyms").when(status == "O", "ligands[1].role").otherwise("signaling_partners.note")
    critical = F.when(F.col("o_totalprice") > 250000, F.array(F.lit("ghost at 'ligands[0]'"))).otherwise(none)
    conflicts = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.array(F.lit("tails differ"))).otherwise(none)
    return o.select("o_orderkey", F.array(path).alias("paths"), critical.alias("critical"), conflicts.alias("conflicts"))


@query("block_decisions", f"""WITH {RECORD}, b AS (SELECT * FROM r CROSS JOIN (VALUES ('ligands'), ('signaling_partners'), ('receptor_info')) AS x(block))
SELECT o_orderkey, block, CASE WHEN block = 'ligands' AND critical THEN 'review' WHEN block = 'signaling_partners' AND conflict THEN 'review'
  WHEN NOT starts_with(path, block) THEN 'auto_accept_clean_block' WHEN path = 'ligands[0].synonyms' THEN 'auto_accept_trivial_block' ELSE 'review' END AS decision FROM b""")
def block_decisions(spark, sf_dir):
    blocks = F.explode(F.array(*map(F.lit, ("ligands", "signaling_partners", "receptor_info"))))
    r = records(spark, sf_dir).withColumn("block", blocks)
    return r.select("o_orderkey", "block", review.block_decision(F.col("block"), F.col("paths"), F.col("critical"), F.col("conflicts")).alias("decision"))


@query("node_decisions", f"WITH {RECORD} SELECT o_orderkey, path, CASE WHEN path = 'ligands[0].synonyms' THEN 'auto_resolve_trivial' ELSE 'review' END AS decision FROM r")
def node_decisions(spark, sf_dir):
    r = records(spark, sf_dir).withColumn("path", F.get("paths", F.lit(0)))
    return r.select("o_orderkey", "path", review.node_decision(F.col("path"), F.col("paths"), F.col("critical"), F.col("conflicts"), True).alias("decision"))


@query("accept_gate", "SELECT o_orderkey, o_totalprice <= 250000 AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F' AS open FROM orders")
def accept_gate(spark, sf_dir):
    paths = F.when(F.get("paths", F.lit(0)) != "ligands[0].synonyms", F.col("paths"))
    return records(spark, sf_dir).select("o_orderkey", review.open_to_all(paths, F.col("critical"), F.col("conflicts")).alias("open"))


@query("coerced_values", r"""SELECT event_id, CASE WHEN regexp_matches(trim(event_type), '^[+-]?[0-9]+$') THEN event_type ELSE '"' || event_type || '"' END AS as_number, CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS as_flag FROM events""")
def coerced_values(spark, sf_dir):
    was = F.try_variant_get(F.try_parse_json("props"), "$.k", "variant")
    said = F.when(F.col("value") > 50, "Yes").otherwise("0")
    return table(spark, sf_dir, "events").select("event_id", F.to_json(review.coerced(was, F.col("event_type"))).alias("as_number"), F.to_json(review.coerced(F.parse_json(F.lit("true")), said)).alias("as_flag"))


@query("fusion_choice", """WITH p AS (SELECT l_orderkey, l_suppkey::VARCHAR AS name, l_quantity::BIGINT AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos, count(*) OVER (PARTITION BY l_orderkey) AS many FROM lineitem)
SELECT l_orderkey, CASE WHEN many > 1 AND n > 0 THEN name END AS chosen FROM p QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, pos) = 1""")
def fusion_choice(spark, sf_dir):
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    grouped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    proteins = F.transform("items", lambda x: F.struct(x["l_suppkey"].cast("string").alias("name"), x["l_quantity"].cast("long").alias("n")))
    return grouped.select("l_orderkey", structures.most(proteins).alias("chosen"))


@query("chain_correction", """WITH g AS (SELECT l_orderkey, arg_min(l_suppkey, (l_linenumber, l_partkey, l_suppkey)) AS said, max(l_suppkey) AS best, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN said <> best THEN CASE WHEN low < 2 THEN 'HALLUCINATION' WHEN high > 40 THEN '7TM_UPGRADE' END END AS trigger,
  CASE WHEN said <> best AND (low < 2 OR high > 40) THEN best ELSE said END AS corrected FROM g""")
def chain_correction(spark, sf_dir):
    best, said = F.max("l_suppkey").cast("string"), F.min_by("l_suppkey", F.struct("l_linenumber", "l_partkey", "l_suppkey")).cast("string")
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(said.alias("said"), best.alias("best"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))

    def member(chain, status):
        return F.struct(F.col(chain).alias("chain"), F.lit(None).cast("string").alias("slug"), status.alias("status"))

    members = F.array(member("best", F.when(F.col("high") > 40, "COMPLETE").otherwise("UNKNOWN")), member("said", F.lit("INCOMPLETE_7TM")))
    alerts = F.when(F.col("low") < 2, F.array(F.struct(F.lit("HALLUCINATION").alias("type"), F.array("said").alias("chains"))))
    o = structures.override(F.col("said"), F.lit(None).cast("string"), F.col("best"), members, alerts)
    return g.select("l_orderkey", o.alias("o")).select("l_orderkey", "o.trigger", F.col("o.corrected_chain_id").cast("long").alias("corrected"))


@query("paper_status", """SELECT doc_id, CASE WHEN text IS NULL THEN 'skipped_no_enriched_data' WHEN n_chars < 50 THEN 'skipped_already_downloaded' WHEN source IS NULL THEN 'failed_no_data'
  WHEN quality IS NULL THEN 'failed_no_doi' WHEN quality = 1 THEN 'success_pdf_downloaded' WHEN lang = 'en' THEN 'fallback_abstract_only' ELSE 'fallback_paywalled' END AS status FROM documents LEFT JOIN labels USING (doc_id)""")
def paper_status(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    made = {"has_entry": F.col("text").isNotNull(), "has_file": F.col("n_chars") < 50, "readable": F.col("source").isNotNull(), "contact": F.lit(True), "doi": F.col("quality").cast("string"), "pmid": F.lit("1"), "pmcid": F.lit("1")}
    made |= {"open_url": F.col("source"), "archive_url": F.lit(None).cast("string"), "abstract": F.when(F.col("lang") == "en", "some"), "file_ok": F.col("quality") == 1}
    return acquisition.paper_status(d.select("doc_id", *[c.alias(n) for n, c in made.items()])).select("doc_id", "status")


@query("pending_requests", "SELECT c_custkey, run FROM customer CROSS JOIN (VALUES (1), (2), (3), (4)) AS r(run) EXCEPT SELECT o_custkey, quarter(o_orderdate) FROM orders")
def pending_requests(spark, sf_dir):
    done = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.quarter("o_orderdate").alias("run"))
    return acquisition.requests(table(spark, sf_dir, "customer"), done, "c_custkey", 4)


@query("paper_siblings", "SELECT a.n_nationkey, coalesce(string_agg(b.n_nationkey::VARCHAR, ',' ORDER BY b.n_nationkey), '') AS siblings FROM nation a LEFT JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey GROUP BY 1")
def paper_siblings(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    found = acquisition.siblings(n, n.groupBy("n_regionkey").agg(F.collect_list("n_nationkey").alias("ids")), "n_nationkey", "n_regionkey")
    return found.select("n_nationkey", F.array_join(F.transform("siblings", lambda x: x.cast("string")), ",").alias("siblings"))
