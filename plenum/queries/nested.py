"""The operators over nested records and lists, on records built from the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from plenum.functions import records
from plenum.operators import acquisition, aggregate, fan_out, report, review, structures, tree
from plenum.plans.tables import table
from plenum.sources import files

from .registry import query
from .votes import LONG, RUNS, runs



def _null(kind: str = "string"):
    return F.lit(None).cast(kind)


def _in_order(df, key, *columns):
    """key, items: the rows of a group in order of the columns."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("items"))


ROSTER = """r AS (SELECT l_orderkey AS k, list_sort(list_distinct(list((l_suppkey % 7)::VARCHAR))) AS roster, list_sort(list_distinct(list((l_linenumber % 7)::VARCHAR))) AS own FROM lineitem GROUP BY 1),
s AS (SELECT *, list_filter(own, lambda x: NOT list_contains(roster, x)) AS alien, list_filter(roster, lambda x: NOT list_contains(own, x)) AS missed, list_filter(own, lambda x: list_contains(roster, x)) AS hits FROM r)"""


def rosters(spark, sf_dir):
    def distinct(c):
        return F.array_sort(F.collect_set((F.col(c) % 7).cast("string")))

    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(distinct("l_suppkey").alias("roster"), distinct("l_linenumber").alias("own"))


@query("alerts", f"""WITH {ROSTER} SELECT k, concat_ws(';', CASE WHEN len(alien) > 0 THEN 'HALLUCINATION:' || array_to_string(alien, ',') END,
  CASE WHEN len(roster) > 1 AND len(hits) > 0 AND len(missed) > 0 THEN 'MISSED_PROTOMER:' || array_to_string(missed, ',') END,
  CASE WHEN len(roster) > 1 AND len(hits) > 0 AND len(missed) = 0 THEN 'CONFIRMED_OLIGOMER:' || array_to_string(own, ',') END) AS alerts FROM s""")
def alerts(spark, sf_dir):
    members = F.transform("roster", lambda c: F.struct(c.alias("chain")))
    found = structures.roster_alerts(F.array_join("own", ","), members)
    return rosters(spark, sf_dir).select("k", F.array_join(F.transform(found, lambda a: F.concat(a["type"], F.lit(":"), F.array_join(a["chains"], ","))), ";").alias("alerts"))


@query("orphan_radar", f"""WITH {ROSTER}, o AS (SELECT *, len(own) > 1 AS cut, list_filter(hits, lambda x: x <> roster[1]) AS orphans, array_to_string(own, ',') AS said FROM s)
SELECT k, CASE WHEN cut THEN roster[1] ELSE said END AS chain, CASE WHEN cut THEN 's' || roster[1] ELSE 'name' END AS name,
  CASE WHEN cut THEN '[DB TRUNCATION: AI correctly identified chains ' || said || ', but DB requires 1. Auto-selected primary chain ' || roster[1] || ' based on: No reason provided]'
    || CASE WHEN len(orphans) > 0 THEN ' [WARNING: Ligands are bound to truncated chains ' || array_to_string(orphans, ', ') || '!]' ELSE '' END END AS note FROM o""")
def orphan_radar(spark, sf_dir):
    suggestion = F.struct(F.get("roster", F.lit(0)).alias("chain_id"), _null().alias("reason")).alias("primary_protomer_suggestion")
    chains = F.transform("roster", lambda c: F.struct(c.alias("chain_id"), F.concat(F.lit("s"), c).alias("slug"))).alias("all_gpcr_chains")
    r = rosters(spark, sf_dir).withColumn("oligo", F.struct(suggestion, chains))
    return r.select("k", fan_out.truncated(F.array_join("own", ","), F.lit("name"), F.col("oligo"), F.col("roster")).alias("t")).select("k", "t.*")


@query("primary_member", f"""WITH {ROSTER} SELECT k, CASE WHEN k % 2 = 0 AND list_contains(roster, own[1]) THEN own[1] WHEN len(hits) = 1 THEN hits[1] WHEN len(hits) > 0 THEN hits[1] ELSE roster[1] END AS chain,
  CASE WHEN k % 2 = 0 AND list_contains(roster, own[1]) THEN 1 WHEN len(hits) = 1 THEN 2 ELSE 4 END AS rank FROM s""")
def primary_member(spark, sf_dir):
    members = F.transform("roster", lambda c: F.struct(c.alias("chain"), c.alias("slug"), F.lit(9).alias("length"), F.lit(0).alias("resolved")))
    even = F.col("k") % 2 == 0
    said = F.when(even, F.get("own", F.lit(0))).otherwise(F.array_join("own", ","))
    # of several hits the first one said counts: where only one chain is said, it is that or none
    said = F.when(even & ~F.array_contains("roster", F.get("own", F.lit(0))), F.array_join("own", ",")).otherwise(said)
    p = structures.primary(members, said, even, F.col("own"))
    return rosters(spark, sf_dir).select("k", p.alias("p")).select("k", "p.chain", F.when(F.col("p.rank") == 0, 4).otherwise(F.col("p.rank")).alias("rank"))


LINES = "l_linenumber, l_partkey, l_suppkey, l_quantity"


@query("identity_clash", f"""WITH l AS (SELECT l_orderkey, l_linenumber, s_nationkey::VARCHAR AS nation FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINES}) = 1),
g AS (SELECT o_orderkey, c_nationkey::VARCHAR AS name, bool_and(nation = c_nationkey::VARCHAR) AS matches, list(nation ORDER BY l_linenumber) AS nations FROM orders JOIN customer ON o_custkey = c_custkey JOIN l ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT o_orderkey, CASE WHEN matches THEN 'RECEPTOR_MATCH' ELSE 'UNIPROT_CLASH' END AS status, list_aggregate(list_sort(list_distinct(nations)), 'string_agg', ',') AS reality, NOT matches AS told FROM g""")
def identity_clash(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf_dir, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    per = _in_order(lines, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "s_nationkey")
    rows = per.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
    polymers = F.transform("items", lambda x: F.struct(F.array(x["l_linenumber"].cast("string")).alias("listed"), F.array(x["s_nationkey"].cast("string")).alias("slugs")))
    chain = F.array_join(F.array_distinct(F.transform("items", lambda x: x["l_linenumber"].cast("string"))), ", ")
    found = structures.receptor_check(F.col("c_nationkey").cast("string"), chain, polymers)
    return rows.select("o_orderkey", found.alias("f")).select("o_orderkey", "f.status", F.array_join(F.array_sort("f.reality"), ",").alias("reality"), F.col("f.message").isNotNull().alias("told"))


@query("distinct_classify", "SELECT o_orderkey, CASE WHEN count(l_suppkey) = 0 THEN 'NO_GPCR' WHEN count(l_suppkey) = 1 THEN 'MONOMER' WHEN count(DISTINCT l_suppkey) = 1 THEN 'HOMOMER' ELSE 'HETEROMER' END AS class FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def distinct_classify(spark, sf_dir):
    per = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(F.col("l_suppkey").alias("slug"))).alias("members"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey").join(per, "o_orderkey", "left")
    return rows.select("o_orderkey", structures.classification(F.coalesce("members", F.array().cast("array<struct<slug:bigint>>"))).alias("class"))


@query("status_waterfall", """WITH l AS (SELECT p_partkey, p_name AS name, ['peptide', 'Protein', 'small'][p_size % 3 + 1] AS kind, ['A', 'B, Q', 'Q', 'none'][p_partkey % 4 + 1] AS chain, ['LIG', 'SO4', 'ABC', '-', 'apo', 'HOH'][p_partkey % 6 + 1] AS code FROM part),
s AS (SELECT *, CASE WHEN code = 'apo' THEN 'SKIPPED_APO' WHEN kind <> 'small' AND chain IN ('A', 'B, Q') THEN 'MATCHED_POLYMER' WHEN code = 'LIG' THEN 'MATCHED_SMALL_MOLECULE' WHEN code IN ('SO4', 'HOH') THEN 'EXCLUDED_BUFFER' ELSE 'GHOST_LIGAND' END AS status FROM l)
SELECT p_partkey, status, CASE WHEN status = 'MATCHED_POLYMER' THEN CASE chain WHEN 'A' THEN 'MKT' ELSE '' END END AS sequence, CASE WHEN status = 'MATCHED_SMALL_MOLECULE' THEN 'K2' END AS key,
  CASE WHEN status = 'GHOST_LIGAND' THEN 'GHOST_LIGAND at ''ligands[' || CASE code WHEN '-' THEN name ELSE code END || ']'': ''' || name || ''' (' || code || ') not found in API entities.' END AS message FROM s""")
def status_waterfall(spark, sf_dir):
    def pick(of, *names):
        return F.get(F.array(*map(F.lit, names)), (of % len(names)).cast("int"))

    ligand = F.struct(F.col("p_name").alias("name"), pick(F.col("p_size"), "peptide", "Protein", "small").alias("type"), pick(F.col("p_partkey"), "A", "B, Q", "Q", "none").alias("chain_id"), pick(F.col("p_partkey"), "LIG", "SO4", "ABC", "-", "apo", "HOH").alias("chem_comp_id"))
    chains = F.array(*[F.struct(F.lit(c).alias("chain"), F.lit(s).alias("sequence")) for c, s in (("A", "MKT"), ("B", ""))])
    parts = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(k).alias("InChIKey"), *[_null().alias(f) for f in ("SMILES", "SMILES_stereo", "cid")]) for c, k in (("LIG", "K1"), ("LIG", "K2"), ("SO4", "K3"))])
    found = table(spark, sf_dir, "part").select("p_partkey", F.get(structures.ligand_checks(F.array(ligand), chains, parts), F.lit(0)).alias("f"))
    return found.select("p_partkey", "f.status", "f.sequence", F.col("f.InChIKey").alias("key"), "f.message")


#: Descriptions, and whether each is an alpha subunit's.
DESCRIPTIONS = {
    "Guanine nucleotide-binding protein G(i) subunit alpha-1": True, "Beta-2 adrenergic receptor": False, "Nanobody 35": False, "mini-Gs chimera": True,
    "Guanine nucleotide-binding protein G(I)/G(S)/G(T) subunit beta-1": False, "Lysozyme": False, "G protein alpha subunit": True,
}


@query("keyword_classifier", f"SELECT p_partkey, {list(DESCRIPTIONS.values())}[p_partkey % {len(DESCRIPTIONS)} + 1] AS hit FROM part")
def keyword_classifier(spark, sf_dir):
    said = F.get(F.array(*map(F.lit, DESCRIPTIONS)), (F.col("p_partkey") % len(DESCRIPTIONS)).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", structures.is_alpha(said).alias("hit"))


def _polymers(rows, description, listed):
    return rows.withColumn("polymers", F.transform("items", lambda x: F.struct(x[description].alias("description"), F.array(x[listed]).alias("listed"), F.array().cast("array<string>").alias("slugs"), F.array().cast("array<struct<accession:string,slug:string>>").alias("names"))))


@query("chain_inventory", """WITH b AS (SELECT p_type, p_brand, min(p_partkey) AS first, '- Chain(s) ' || string_agg(p_name, ', ' ORDER BY p_name) || ': ' || p_brand AS line FROM part GROUP BY p_type, p_brand)
SELECT p_type, '### CHAIN INVENTORY REMINDER' || chr(10) || 'This structure (' || p_type || ') contains EXACTLY ' || any_value(n) || ' unique polymer chain(s):' || chr(10) || string_agg(line, chr(10) ORDER BY first) AS text
FROM b JOIN (SELECT p_type, count(DISTINCT p_name) AS n FROM part GROUP BY 1) USING (p_type) GROUP BY p_type""")
def chain_inventory(spark, sf_dir):
    rows = _polymers(_in_order(table(spark, sf_dir, "part"), "p_type", "p_partkey", "p_brand", "p_name"), "p_brand", "p_name")
    return rows.select("p_type", acquisition.inventory(F.col("p_type"), F.col("polymers")).alias("text"))


@query("exclude_list", "SELECT p_partkey, 'LIG,Q' || p_size AS codes, 'LIG' AS first_name, p_brand AS description FROM part")
def exclude_list(spark, sf_dir):
    rows = _polymers(_in_order(table(spark, sf_dir, "part"), "p_partkey", "p_brand", "p_name", "p_size"), "p_brand", "p_name")
    codes = F.array(F.lit("LIG"), F.lit("SO4"), F.lit("HOH"), F.concat(F.lit("Q"), F.get("items", F.lit(0))["p_size"].cast("string")))
    rows = rows.withColumns({"components": F.transform(codes, lambda c: F.struct(c.alias("code"), F.lit("").alias("name"), _null().alias("cid"))), "entity": F.col("p_partkey").cast("string"), "method": _null(), "resolution": _null("double"), "release_date": _null()})
    found = acquisition.simplified(rows)
    others = F.col("simple.non_polymer_components")
    return found.select("p_partkey", F.array_join(F.transform(others, lambda c: c["chem_comp_id"]), ",").alias("codes"), F.get(others, F.lit(0))["name"].alias("first_name"), F.get("simple.polymer_components", F.lit(0))["description"].alias("description"))


@query("prompt_parts", "SELECT n_nationkey, md5('T' || chr(10) || chr(10) || '### CHAIN INVENTORY REMINDER' || chr(10) || 'This structure (' || n_name || ') contains 0 polymer chains.' || chr(10) || chr(10) || CASE WHEN n_regionkey > 2 THEN '### IMPORTANT: SIBLING STRUCTURES WARNING' || chr(10) || 'This paper also reports structures for the following PDB IDs: X, Y.' || chr(10) || 'Ensure you are extracting data ONLY for ' || n_name || '. Do NOT mix up ligands or active states with the sibling structures reported in the same paper.' || chr(10) || chr(10) ELSE '' END || '--- PDB METADATA FOR ' || n_name || ' ---' || chr(10) || '{\"structure_details\":{\"pdb_id\":\"' || n_name || '\",\"method\":\"Unknown\"},\"polymer_components\":[],\"non_polymer_components\":[]}' || chr(10) || chr(10) || '--- FULL PAPER ---' || chr(10)) AS prompt FROM nation")
def prompt_parts(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    polymers = F.array().cast("array<struct<description:string,listed:array<string>,slugs:array<string>,names:array<struct<accession:string,slug:string>>>>")
    parts = F.array().cast("array<struct<code:string,name:string,cid:string>>")
    siblings = F.when(F.col("n_regionkey") > 2, F.array(F.lit("X"), F.lit("Y"))).otherwise(F.array().cast("array<string>"))
    rows = n.select(F.col("n_name").alias("entity"), polymers.alias("polymers"), parts.alias("components"), siblings.alias("siblings"), _null().alias("method"), _null("double").alias("resolution"), _null().alias("release_date"))
    found = acquisition.prompts(rows, "T").select(F.col("entity").alias("n_name"), F.md5(F.col("prompt").cast("binary")).alias("prompt"))
    return n.select("n_nationkey", "n_name").join(found, "n_name").select("n_nationkey", "prompt")


@query("threshold_class", "SELECT p_partkey, CASE WHEN p_retailprice IS NULL THEN 'unknown' WHEN p_retailprice < 950 THEN 'small-molecule' ELSE 'peptide' END AS class FROM part")
def threshold_class(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", acquisition.component_kind(F.col("p_retailprice").cast("string"), 950).alias("class"))


@query("name_standardise", r"SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Nanobody-' || regexp_extract(p_brand, '(\d+)', 1) WHEN 1 THEN 'BRIL' ELSE p_name END AS name FROM part")
def name_standardise(spark, sf_dir):
    k, number = F.col("p_partkey") % 3, F.regexp_extract("p_brand", r"(\d+)", 1)
    said = F.when(k == 0, F.concat(F.lit("nb "), number)).when(k == 1, F.concat("p_name", F.lit(" (BRIL fusion)"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", records.standard_name(said).alias("name"))


def oligo(spark, sf_dir):
    """An order as an oligomer analysis: its price corrects the chain, its state says what it is."""
    applied, status = F.col("o_totalprice") > 250000, F.col("o_orderstatus")
    over = F.struct(applied.alias("applied"), F.lit("A").alias("original_chain_id"), F.lit("B").alias("corrected_chain_id"), F.lit("HALLUCINATION").alias("trigger"))
    told = F.when(status == "O", F.array(F.struct(F.lit("MISSED_PROTOMER").alias("type"), F.lit("m").alias("message"))))
    chains = F.array(*[F.struct(F.lit(c).alias("chain_id"), F.lit("s").alias("slug"), F.when(status == "P", "INCOMPLETE_7TM").otherwise("COMPLETE").alias("7tm_status")) for c in "AB"])
    kind = F.when(status == "F", "HOMOMER").otherwise("MONOMER")
    return table(spark, sf_dir, "orders").withColumn("oligo", F.struct(over.alias("chain_id_override"), told.alias("alerts"), chains.alias("all_gpcr_chains"), kind.alias("classification")))


@query("note_concat", "SELECT o_orderkey, concat_ws(' ', o_orderpriority, CASE WHEN o_totalprice > 250000 THEN '[CHAIN CORRECTED: A -> B, reason: HALLUCINATION]' END, CASE WHEN o_orderstatus = 'F' THEN '[HOMOMER: chains A, B]' END, CASE WHEN o_orderstatus = 'O' THEN '[MISSED_PROTOMER: m]' END) AS note FROM orders")
def note_concat(spark, sf_dir):
    return oligo(spark, sf_dir).select("o_orderkey", fan_out.note(F.concat(F.lit(" "), "o_orderpriority"), F.col("oligo"), _null()).alias("note"))


@query("review_highlight", "SELECT o_orderkey, o_totalprice > 250000 OR o_orderstatus IN ('O', 'F', 'P') OR o_orderkey % 3 = 0 AS look FROM orders")
def review_highlight(spark, sf_dir):
    return oligo(spark, sf_dir).select("o_orderkey", review.highlighted(F.col("oligo"), F.when(F.col("o_orderkey") % 3 == 0, "A, B").otherwise("A")).alias("look"))


@query("promoted_alerts", "SELECT o_orderkey, concat_ws('|', CASE WHEN o_totalprice > 250000 THEN 'CHAIN_ID CORRECTED at ''receptor_info'': A -> B (HALLUCINATION). Human confirmation required.' END, CASE WHEN o_orderstatus = 'O' THEN 'OLIGOMER ALERT at ''receptor_info'': [MISSED_PROTOMER] m' END, CASE WHEN o_orderstatus = 'P' THEN 'STRUCTURAL QUALITY at ''receptor_info'': One or more GPCR chains have INCOMPLETE 7TM domains.' END) AS findings FROM orders")
def promoted_alerts(spark, sf_dir):
    return oligo(spark, sf_dir).select("o_orderkey", F.array_join(report.promoted(F.col("oligo")), "|").alias("findings"))


@query("default_candidate", "SELECT l_orderkey, CASE WHEN bool_or(l_discount > 0.09) THEN arg_min(pos, pos) FILTER (l_discount > 0.09) WHEN bool_or(l_quantity > 45) THEN arg_min(pos, pos) FILTER (l_quantity > 45) WHEN bool_or(l_tax > 0.07) THEN arg_min(pos, pos) FILTER (l_tax > 0.07) ELSE 0 END::INT AS place FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax) - 1 AS pos FROM lineitem) GROUP BY 1")
def default_candidate(spark, sf_dir):
    per = _in_order(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")
    flags = F.transform("items", lambda x: F.struct((x["l_discount"] > 0.09).alias("verified"), (x["l_quantity"] > 45).alias("majority"), (x["l_tax"] > 0.07).alias("best")))
    return per.select("l_orderkey", review.default_candidate(flags).alias("place"))


AUX = {"1-URGENT": ("Nanobody", "nanobodies"), "2-HIGH": ("scFv", "scfv"), "3-MEDIUM": ("GRK", "grk"), "5-LOW": ("Antibody fab fragment", "antibodies"), "4-NOT SPECIFIED": ("DARPin", "other_aux_proteins")}


@query("fan_out_dispatch", f"SELECT target, count(*) AS n, count(DISTINCT name) AS names FROM (SELECT CASE o_orderpriority {' '.join(f'''WHEN '{p}' THEN '{t}' ''' for p, (_, t) in AUX.items())} ELSE 'other_aux_proteins' END AS target, o_orderstatus AS name FROM orders UNION ALL SELECT 'ligands', o_orderpriority FROM orders UNION ALL SELECT 'structures', o_orderstatus FROM orders UNION ALL SELECT 'arrestins', o_orderstatus FROM orders WHERE o_orderkey % 2 = 0) GROUP BY target")
def fan_out_dispatch(spark, sf_dir):
    kind = F.try_element_at(F.create_map(*[F.lit(x) for p, (k, _) in AUX.items() for x in (p, k)]), F.col("o_orderpriority"))
    helper = F.array(F.struct(F.col("o_orderstatus").alias("name"), F.struct(kind.alias("value")).alias("type")))
    ligand = F.array(F.struct(F.col("o_orderpriority").alias("name"), F.lit("A").alias("chain_id")))
    arrestin = F.when(F.col("o_orderkey") % 2 == 0, F.struct(F.col("o_orderstatus").alias("uniprot_entry_name")))
    whole = F.struct(F.struct(F.col("o_orderstatus").alias("uniprot_entry_name")).alias("receptor_info"), ligand.alias("ligands"), helper.alias("auxiliary_proteins"), F.struct(arrestin.alias("arrestin")).alias("signaling_partners"))
    made = fan_out.tables(table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("entity"), F.to_variant_object(whole).alias("v")))
    names = {"structures": "Receptor_UniProt", "ligands": "Name", "arrestins": "UniProt", "g_proteins": "Note"}
    every = None
    for target, rows in made.items():
        one = rows.select(F.lit(target).alias("target"), F.col(names.get(target, "Name")).alias("name"))
        every = one if every is None else every.unionByName(one)
    return every.groupBy("target").agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"))


@query("header_diff", "SELECT * FROM (VALUES ('missing', 'c_nationkey'), ('missing', 'c_acctbal'), ('missing', 'c_mktsegment'), ('extra', 'c_phone')) AS t(side, k)")
def header_diff(spark, sf_dir):
    missing, extra = files.header_difference(table(spark, sf_dir, "customer").columns, ["c_name", "c_phone", "c_custkey"])
    return spark.createDataFrame([("missing", c) for c in missing] + [("extra", c) for c in extra], "side string, k string")


@query("html_extract", r"""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, 'href="([^"]*)"', 1) AS link, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages""")
def html_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", acquisition.page_facts(F.col("html"), F.col("url")).alias("p")).select("page_id", "p.*")


@query("json_props", "SELECT event_id, 'k' AS path, 'scalar' AS kind, json_extract(props, '$.k')::VARCHAR AS value FROM events UNION ALL SELECT event_id, 'a.e', 'scalar', '\"' || event_type || '\"' FROM events UNION ALL SELECT event_id, 'a', 'object', '{\"e\":\"' || event_type || '\"}' FROM events")
def json_props(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    whole = F.parse_json(F.concat(F.expr("left(props, length(props) - 1)"), F.lit(', "a": {"e": "'), "event_type", F.lit('"}}')))
    return tree.nodes(e.select("event_id", whole.alias("v")), ["event_id"]).select("event_id", "path", "kind", "value")


@query("ground_truth_overwrite", "SELECT o_orderkey, coalesce(c_mktsegment, o_orderpriority) AS method, o_totalprice AS resolution, CASE WHEN o_orderkey % 2 = 0 THEN '2024-01-01' END AS released, 'kept' AS other FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def ground_truth_overwrite(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    info = F.struct(F.col("o_orderpriority").alias("method"), F.lit("kept").alias("other"))
    rows = o.join(c, o.o_custkey == c.c_custkey, "left").withColumn("v", F.to_variant_object(F.struct(info.alias("structure_info"))))
    v = aggregate.with_truth(F.col("v"), F.col("c_mktsegment"), F.col("o_totalprice"), F.when(F.col("o_orderkey") % 2 == 0, "2024-01-01"))
    got = {n: F.try_variant_get("v", f"$.structure_info.{f}", kind).alias(n) for n, f, kind in (("method", "method", "string"), ("resolution", "resolution", "double"), ("released", "release_date", "string"), ("other", "other", "string"))}
    return rows.select("o_orderkey", v.alias("v")).select("o_orderkey", *got.values())


@query("run_failures", "SELECT c_custkey::VARCHAR AS entity, CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders) THEN 'No valid AI runs found' ELSE 'Enriched data not available' END AS error FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) OR c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def run_failures(spark, sf_dir):
    asked, made, there = (table(spark, sf_dir, t).select(F.col(c).cast("string").alias("entity")) for t, c in (("customer", "c_custkey"), ("orders", "o_custkey"), ("supplier", "s_suppkey")))
    return aggregate.failures(asked, made, there)


def nested(spark, sf_dir):
    when = F.struct("part", "band").alias("when")
    return runs(spark, sf_dir).select(F.concat_ws("/", "user_id", "week").alias("e"), "event_id", F.to_variant_object(F.struct("event_type", when)).alias("v"))


PATHED = f"{RUNS}, {LONG}, named AS (SELECT * FROM (VALUES ('event_type', 'event_type'), ('part', 'when.part'), ('band', 'when.band')) AS t(field, path))"


@query("tree_votes", f"""WITH {PATHED} SELECT user_id || '/' || week AS e, path, '"' || winner || '"' AS winner, votes, (SELECT count(*) FROM runs r WHERE r.user_id = won.user_id AND r.week = won.week) AS voters FROM won JOIN named USING (field)""")
def tree_votes(spark, sf_dir):
    return tree.majority(nested(spark, sf_dir), "e", "event_id")[1]


@query("tree_best", f"WITH {PATHED} SELECT user_id || '/' || week AS e, event_id, score FROM best")
def tree_best(spark, sf_dir):
    df = nested(spark, sf_dir)
    return tree.best_record(df, tree.majority_record(df, "e", "event_id"), "e", "event_id").select("e", "event_id", "score")


@query("tree_diff", f"""WITH {PATHED} SELECT user_id || '/' || week AS e, path, '"' || long.value || '"' AS best_value, '"' || winner || '"' AS majority_value, votes AS n FROM best JOIN long USING (user_id, week, event_id) JOIN won USING (user_id, week, field) JOIN named USING (field) WHERE long.value IS DISTINCT FROM winner""")
def tree_diff(spark, sf_dir):
    df = nested(spark, sf_dir)
    votes, _, major = tree.polled(df, "e", "event_id")
    return tree.differences(tree.best_record(df, major, "e", "event_id"), major, votes, "e")


@query("display_copy", """SELECT c_nationkey, CASE WHEN count(*) > 3 THEN list_append((list(c_custkey::VARCHAR ORDER BY c_custkey))[:3], '... (' || (count(*) - 3) || ' more)')[4] END AS fourth, count(*) AS others FROM customer GROUP BY 1""")
def display_copy(spark, sf_dir):
    ids = F.transform(F.array_sort(F.collect_list("c_custkey")), lambda x: x.cast("string"))
    inner = F.struct(ids.alias("synonyms"), ids.alias("others"))
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.to_variant_object(F.struct(F.array(F.struct(inner.alias("in"))).alias("list"))).alias("v"))
    shown = tree.display(rows, ["c_nationkey"])
    others = F.size(F.try_variant_get("v", "$.list[0].in.others", "array<string>")).cast("long")
    return shown.select("c_nationkey", F.try_variant_get("v", "$.list[0].in.synonyms[3]", "string").alias("fourth"), others.alias("others"))


@query("integrity", """SELECT o_orderkey, '.receptor_info' AS path, 'Ghost Chain at ''.receptor_info'': ''' || o_orderstatus || ''' not in PDB Source.' AS message FROM orders WHERE o_orderstatus NOT IN ('F', 'P')
UNION ALL SELECT o_orderkey, '.receptor_info', 'Invalid Format at ''.receptor_info'': ''' || o_orderpriority || ''' (Expected: name_species)' FROM orders WHERE o_orderkey % 2 = 1
UNION ALL SELECT o_orderkey, '.receptor_info', 'Fake UniProt ID at ''.receptor_info'': ''x_' || o_custkey || ''' does not exist in UniProtKB.' FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 3 = 0
UNION ALL SELECT o_orderkey, '.receptor_info', '[API_UNAVAILABLE] at ''.receptor_info'': Could not verify UniProt ID ''x_' || o_custkey || '''.' FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 3 = 1""")
def integrity(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    name = F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderpriority")).otherwise(F.concat(F.lit("x_"), F.col("o_custkey").cast("string")))
    info = F.struct(F.col("o_orderstatus").alias("chain_id"), name.alias("uniprot_entry_name"))
    walked = tree.nodes(o.select(F.col("o_orderkey").alias("entity"), F.to_variant_object(F.struct(info.alias("receptor_info"))).alias("v")), ["entity"])
    context = o.select(F.col("o_orderkey").alias("entity"), F.array(F.lit("F"), F.lit("P")).alias("chain_ids"), F.array().cast("array<string>").alias("codes"), _null().alias("method"))
    known = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 1").select(F.concat(F.lit("uniprot:x_"), F.col("c_custkey").cast("string")).alias("key"), (F.col("c_custkey") % 3 == 2).alias("found"))
    return structures.integrity(walked, context, known).withColumnRenamed("entity", "o_orderkey")


def _same(column, text):
    return " + ".join(f"(substr({column}, {i}, 1) = '{c}')::INT" for i, c in enumerate(text, 1))


@query("alpha_tails", f"""WITH c AS (SELECT c_custkey, right(c_name, 4) AS tail FROM customer), s AS (SELECT *, ({_same("tail", "0011")})::BIGINT AS a, ({_same("tail", "0145")})::BIGINT AS b FROM c)
SELECT c_custkey, 'success' AS status, CASE WHEN a >= b THEN 'gnas2_human' ELSE 'gnai1_human' END AS best, greatest(a, b) AS score, tail, CASE WHEN a = b THEN 2 ELSE 1 END AS ties FROM s""")
def alpha_tails(spark, sf_dir):
    references = spark.createDataFrame([("P63092", "AA0011"), ("P63096", "AA0145")], "accession string, sequence string")
    names = F.array().cast("array<struct<accession:string,slug:string>>")
    chain = F.struct(F.lit("G protein alpha subunit").alias("description"), F.col("c_name").alias("any_sequence"), names.alias("names"))
    found = structures.tails(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), F.array(chain).alias("polymers")), references)
    return found.select(F.col("entity").alias("c_custkey"), "status", "best", F.col("score").cast("long").alias("score"), "tail", F.size("ties").alias("ties"))


@query("segments_complete", """WITH g AS (SELECT event_id, json_extract(props, '$.k')::BIGINT AS b, json_extract(props, '$.k')::BIGINT + event_id % 30 AS e FROM events),
h AS (SELECT event_id, list_sum(list_transform(range(0, 7), lambda i: CASE WHEN (10 - greatest(0, least(i * 15 + 9, e) - greatest(i * 15, b) + 1)) / 10.0 >= 0.5 THEN 1 ELSE 0 END))::BIGINT AS resolved FROM g)
SELECT event_id, resolved, 7 AS total, CASE WHEN resolved >= 6 THEN 'COMPLETE' ELSE 'INCOMPLETE_7TM' END AS status FROM h""")
def segments_complete(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    mid = k + (F.col("event_id") % 30 / 2).cast("long")
    # two gaps that touch stand for one
    gaps = F.array(F.struct(mid.alias("b"), (k + F.col("event_id") % 30).alias("e")), F.struct(k.alias("b"), mid.alias("e")))
    segments = F.array(*[F.struct(F.lit(i * 15).cast("long").alias("b"), F.lit(i * 15 + 9).cast("long").alias("e")) for i in range(7)])
    done = structures.completeness(segments, gaps)
    return e.select("event_id", done.alias("d")).select("event_id", F.col("d.resolved").cast("long").alias("resolved"), "d.total", "d.status")


@query("chain_features", "SELECT p_partkey, 'C' AS chain, CASE WHEN p_size % 2 = 0 THEN '1-' || p_size ELSE (p_size + 90) || '-' || (p_size + 95) END AS segments, '3-' || (3 + p_size) AS gaps, 'P:1' AS proteins FROM part")
def chain_features(spark, sf_dir):
    size = F.col("p_size").cast("string")
    own = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('[{"type": "Membrane", "feature_positions": [{"beg_seq_id": 1, "end_seq_id": '), size, F.lit("}]}]"))).otherwise("[]")
    mapped = F.concat(F.lit('[{"rcsb_id": "P", "rcsb_uniprot_feature": [{"type": "transmembrane", "feature_positions": [{"beg_seq_id": '), size, F.lit(', "end_seq_id": '), (F.col("p_size") + 5).cast("string"), F.lit("}]}]}]"))
    align = '[{"reference_database_name": "UniProt", "reference_database_accession": "P", "aligned_regions": [{"ref_beg_seq_id": 0, "entity_beg_seq_id": 90, "length": 100}]}]'
    unseen = F.concat(F.lit('[{"type": "UNMODELED", "feature_positions": [{"beg_seq_id": 3, "end_seq_id": '), (3 + F.col("p_size")).cast("string"), F.lit("}]}]"))
    text = F.concat(F.lit('{"data": {"entry": {"polymer_entities": [{"rcsb_polymer_entity_feature": '), own, F.lit(', "uniprots": '), mapped, F.lit(f', "rcsb_polymer_entity_align": {align}, "polymer_entity_instances": [{{"rcsb_polymer_entity_instance_container_identifiers": {{"auth_asym_id": "C"}}, "rcsb_polymer_instance_feature": '), unseen, F.lit("}]}]}}}"))
    found = structures.features(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entity"), F.parse_json(text).alias("v")))

    def shown(c):
        return F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["b"].cast("string"), s["e"].cast("string"))), ",")

    return found.select(F.col("entity").alias("p_partkey"), "chain", shown("segments").alias("segments"), shown("gaps").alias("gaps"), F.array_join(F.transform("proteins", lambda p: F.concat_ws(":", p["name"], p["n"].cast("string"))), ",").alias("proteins"))


@query("loaded_records", "SELECT c_custkey::VARCHAR AS entity, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS controversies, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS critical FROM customer")
def loaded_records(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    found = o.select(F.col("o_custkey").cast("string").alias("entity"), F.col("o_orderkey").cast("string").alias("path"), F.col("o_orderstatus").alias("best_value"), F.col("o_orderpriority").alias("majority_value"))
    reports = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("entity"), F.array("c_mktsegment").alias("critical"), F.array().cast("array<string>").alias("conflicts"))
    got = review.loaded(c.select(F.col("c_custkey").cast("string").alias("entity")), found.unionByName(found), reports)
    return got.select("entity", F.size("controversies").cast("long").alias("controversies"), F.get("critical", F.lit(0)).alias("critical"))


@query("batch_answers", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'no key' WHEN 1 THEN 'error' WHEN 2 THEN 'no function call' END AS reason, CASE WHEN event_id % 4 = 3 THEN event_id % 7 END AS run, CASE WHEN event_id % 4 = 3 THEN event_type END AS said FROM events""")
def batch_answers(spark, sf_dir):
    k = F.col("event_id") % 4
    call = F.concat(F.lit('{"candidates": [{"content": {"parts": [{"text": "t"}, {"functionCall": {"args": {"said": "'), "event_type", F.lit('"}}}]}}]}'))
    key = F.concat(F.lit('"key": "'), F.col("event_id").cast("string"), F.lit("_run_"), (F.col("event_id") % 7).cast("string"), F.lit('", '))
    text = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(", "), F.when(k == 0, "").otherwise(key), F.when(k == 1, F.lit('"error": {"code": 5}, ')).otherwise(""), F.lit('"response": '), F.when(k == 2, '{"candidates": []}').otherwise(call), F.lit("}"))
    good, bad = files.answers(table(spark, sf_dir, "events").select(F.parse_json(text).alias("v")))
    none = bad.select(F.try_variant_get("v", "$.id", "bigint").alias("event_id"), "reason", _null("bigint").alias("run"), _null().alias("said"))
    return good.select(F.col("entity").cast("long").alias("event_id"), _null().alias("reason"), "run", F.try_variant_get("v", "$.said", "string").alias("said")).unionByName(none)


@query("names_written", "SELECT p_partkey, CASE WHEN p_size <= 24 THEN 'n' || p_size END AS first, 'old' AS second FROM part")
def names_written(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    units = F.concat(F.lit('[{"rcsb_id": "S'), F.col("p_size").cast("string"), F.lit('"}, {"rcsb_id": "T", "x_entry_name_slug": "old"}]'))
    docs = p.select(F.col("p_partkey").alias("entity"), F.parse_json(F.concat(F.lit('{"data": {"entry": {"polymer_entities": [{"uniprots": '), units, F.lit("}]}}}"))).alias("v"))
    names = p.where("p_size <= 24").select(F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("accession"), F.concat(F.lit("n"), F.col("p_size").cast("string")).alias("name")).distinct()
    at = "$.data.entry.polymer_entities[0].uniprots"
    found = acquisition.named(docs, names, "x")
    return found.select(F.col("entity").alias("p_partkey"), F.try_variant_get("v", f"{at}[0].x_entry_name_slug", "string").alias("first"), F.try_variant_get("v", f"{at}[1].x_entry_name_slug", "string").alias("second"))


@query("entries_enriched", """SELECT p_partkey, CASE WHEN p_size <= 24 THEN 'n' || p_size END AS name, CASE WHEN p_retailprice < 900 THEN 'small-molecule' ELSE 'peptide' END AS kind,
  CASE WHEN p_size > 40 THEN p_size::VARCHAR END AS cid, CASE WHEN p_size % 2 = 0 THEN 'C' || p_size END AS smiles, p_partkey % 3 = 0 AS sibling FROM part WHERE p_partkey % 10 <> 0""")
def entries_enriched(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    unit = F.concat(F.lit('[{"uniprots": [{"rcsb_id": "S'), size, F.lit('"}]}]'))
    part = F.concat(F.lit('[{"nonpolymer_comp": {"chem_comp": {"id": "Q'), size, F.lit('", "formula_weight": '), F.col("p_retailprice").cast("string"), F.lit('}, "rcsb_chem_comp_descriptor": {"InChIKey": "K'), size, F.lit('"}}}, null]'))
    docs = p.select(F.col("p_partkey").alias("entity"), F.parse_json(F.concat(F.lit('{"data": {"entry": {"polymer_entities": '), unit, F.lit(', "nonpolymer_entities": '), part, F.lit("}}}"))).alias("v"))
    sizes = p.select("p_size").distinct().withColumn("s", F.col("p_size").cast("string"))
    names = sizes.where("p_size <= 24").select(F.concat(F.lit("S"), "s").alias("accession"), F.concat(F.lit("n"), "s").alias("name"))
    compounds = sizes.where("p_size > 40").select(F.concat(F.lit("K"), "s").alias("key"), F.col("s").alias("cid"), F.array("s").alias("synonyms"))
    shapes = sizes.where("p_size % 2 = 0").select(F.concat(F.lit("Q"), "s").alias("code"), F.concat(F.lit("C"), "s").alias("SMILES"), _null().alias("SMILES_stereo"), F.lit("other").alias("InChIKey"))
    papers = p.where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("entity"), F.array(F.lit("X")).alias("siblings"))
    done = p.where("p_partkey % 10 = 0").select(F.col("p_partkey").alias("entity"))
    found = acquisition.enriched(docs, done, names, compounds, shapes, papers, "x")
    paths = {"name": "polymer_entities[0].uniprots[0].x_entry_name_slug", "kind": "nonpolymer_entities[0].nonpolymer_comp.x_determined_type", "cid": "nonpolymer_entities[0].nonpolymer_comp.x_pubchem_cid", "smiles": "nonpolymer_entities[0].nonpolymer_comp.rcsb_chem_comp_descriptor.SMILES"}
    got = [F.try_variant_get("v", f"$.data.entry.{path}", "string").alias(n) for n, path in paths.items()]
    return found.select(F.col("entity").alias("p_partkey"), *got, F.try_variant_get("v", "$.data.entry.sibling_pdbs[0]", "string").isNotNull().alias("sibling"))
