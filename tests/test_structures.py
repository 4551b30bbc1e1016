"""Records of annotated structures against small entries, with every rule and with what is missing or null."""

import json

import pytest
from pyspark.sql import functions as F

from plenum.operators import structures, tree


def polymer(chains, slugs=(), seq=None, description=None, accessions=None, length=None):
    return {
        "rcsb_polymer_entity": {"pdbx_description": description},
        "rcsb_polymer_entity_container_identifiers": {"auth_asym_ids": list(chains)},
        "entity_poly": {"pdbx_seq_one_letter_code_can": seq, "rcsb_sample_sequence_length": length},
        "uniprots": [{"rcsb_id": a, "x_entry_name_slug": s} for a, s in zip(accessions or ["P0"] * len(slugs), slugs, strict=True)],
        "polymer_entity_instances": [None, {"rcsb_polymer_entity_instance_container_identifiers": None}, *({"rcsb_polymer_entity_instance_container_identifiers": {"auth_asym_id": c, "asym_id": None}} for c in chains)],
    }


def component(code, **more):
    return {"nonpolymer_comp": {"chem_comp": {"id": code, "name": "n"}, "rcsb_chem_comp_descriptor": {"InChIKey": more.get("key")}, "x_pubchem_cid": more.get("cid")}, "nonpolymer_entity_instances": [{"rcsb_nonpolymer_entity_instance_container_identifiers": {"auth_asym_id": "Z"}}]}


ENTRY = {
    "exptl": [{"method": "ELECTRON MICROSCOPY"}],
    "em_3d_reconstruction": [{"resolution": None}],
    "refine": [{"ls_d_res_high": 2.5}],
    "rcsb_accession_info": {"initial_release_date": "2024-02-07T00:00:00Z"},
    "polymer_entities": [polymer("A", ["oprm_human"], "MKT", length=400), polymer("BC", ["gnai1_human", "drd2_human"], "AAAA"), polymer("D", ["gnai1_human"], "XXCGLF", "G alpha i", ["P63096"])],
    "nonpolymer_entities": [None, component("LIG", key="K1"), component("LIG", key="K2", cid="7"), component("SO4")],
}
EMPTY = dict.fromkeys(("exptl", "refine", "polymer_entities", "nonpolymer_entities"))


@pytest.fixture(scope="module")
def entries(spark):
    rows = [("e", json.dumps({"data": {"entry": ENTRY}})), ("n", json.dumps({"data": {"entry": EMPTY}})), ("odd", json.dumps({"data": {"entry": {"polymer_entities": "text", "exptl": [None]}}})), ("none", json.dumps({"data": None}))]
    return structures.entries(spark.createDataFrame(rows, "entity string, t string").select("entity", F.parse_json("t").alias("v")), "x").cache()


def test_entries_keep_what_has_the_right_type(entries):
    got = {r["entity"]: r for r in entries.collect()}
    assert set(got) == {"e", "n", "odd"}
    e = got["e"]
    assert (e["method"], e["resolution"], e["release_date"], sorted(e["chain_ids"]), e["codes"]) == ("ELECTRON MICROSCOPY", 2.5, "2024-02-07", ["A", "B", "C", "D", "Z"], ["LIG", "SO4"])
    for k in ("n", "odd"):
        assert (got[k]["method"], got[k]["resolution"], got[k]["release_date"], got[k]["polymers"], got[k]["chain_ids"], got[k]["codes"]) == (None, None, None, [], [], [])


LIGAND = "array<struct<name:string,type:string,chain_id:string,chem_comp_id:string>>"


def test_ligands_take_the_first_rule_that_holds(spark, entries):
    given = [("Apo", None, None, None), ("p", "Peptide", "A, B", None), ("p", "protein", "Q", "LIG"), ("l", None, None, " LIG "), ("s", None, None, "SO4"), ("g", None, "A", "ABC"), ("g2", "peptide", "none", "-"), ("g3", None, None, None)]
    rows = spark.createDataFrame([("e", given), ("n", given[3:4]), ("e", None)], f"entity string, l {LIGAND}").join(entries, "entity")
    got = [r["c"] for r in rows.select("entity", structures.ligand_checks(F.col("l"), F.col("chains"), F.col("components")).alias("c")).orderBy("entity", F.size("c")).collect()]
    assert got[0] == []
    assert [x["status"] for x in got[1]] == ["SKIPPED_APO", "MATCHED_POLYMER", "MATCHED_SMALL_MOLECULE", "MATCHED_SMALL_MOLECULE", "EXCLUDED_BUFFER", "GHOST_LIGAND", "GHOST_LIGAND", "GHOST_LIGAND"]
    assert got[1][1]["sequence"] == "MKT / AAAA"
    assert (got[1][3]["InChIKey"], got[1][3]["cid"]) == ("K2", "7")
    assert got[1][5]["message"] == "GHOST_LIGAND at 'ligands[ABC]': 'g' (ABC) not found in API entities."
    assert got[1][6]["message"] == "GHOST_LIGAND at 'ligands[g2]': 'g2' (-) not found in API entities."
    assert got[1][7]["message"] == "GHOST_LIGAND at 'ligands[g3]': 'g3' (no comp_id) not found in API entities."
    assert [x["status"] for x in got[2]] == ["GHOST_LIGAND"]


@pytest.mark.parametrize(
    "name,chain,status,reality,message",
    [
        ("oprm_human", "A", "RECEPTOR_MATCH", ["oprm_human"], None),
        ("drd2_human", "B, C", "RECEPTOR_MATCH", ["gnai1_human", "drd2_human"], None),
        ("oprm_human", "A,B", "UNIPROT_CLASH", ["oprm_human", "gnai1_human", "drd2_human"], "UNIPROT_CLASH at 'receptor_info': 'oprm_human' clashes on Chain B -> ['gnai1_human', 'drd2_human']."),
        ("oprm_human", "Q", None, [], None),
        (None, "A", None, [], None),
        ("oprm_human", None, None, [], None),
    ],
)
def test_receptors_match_or_clash(entries, name, chain, status, reality, message):
    c = structures.receptor_check(F.lit(name).cast("string"), F.lit(chain).cast("string"), F.col("polymers"))
    assert tuple(entries.where("entity = 'e'").select(c.alias("c")).first()["c"]) == (status, reality, message)


def test_rosters_alerts_and_the_member_that_stands_for_all(entries):
    rows = entries.withColumn("r", structures.roster(F.col("polymers")))
    got = {r["entity"]: ([tuple(x) for x in r["r"]], r["k"]) for r in rows.select("entity", "r", structures.classification(F.col("r")).alias("k")).collect()}
    assert got["e"] == ([("A", "oprm_human", 400, "A"), ("B", "drd2_human", 4, "B"), ("C", "drd2_human", 4, "C")], "HETEROMER")
    assert got["n"] == ([], "NO_GPCR")

    def alerts(chain):
        c = structures.roster_alerts(F.lit(chain).cast("string"), F.col("r"))
        return [tuple(x) for x in rows.where("entity = 'e'").select(c.alias("c")).first()["c"]]

    assert alerts("A, D") == [("HALLUCINATION", ["D"]), ("MISSED_PROTOMER", ["B", "C"])]
    assert alerts("C,B,A") == [("CONFIRMED_OLIGOMER", ["A", "B", "C"])]
    assert alerts(None) == []

    def chosen(chain, partner, ligands, resolved, entity="e"):
        members = F.transform("r", lambda x: F.struct(x["chain"].alias("chain"), x["slug"].alias("slug"), x["length"].alias("length"), F.coalesce(F.try_element_at(F.create_map(*[F.lit(i) for p in resolved.items() for i in p]), x["chain"]), F.lit(0)).alias("resolved")))
        c = structures.primary(members, F.lit(chain).cast("string"), F.lit(partner), F.array(*[F.lit(x) for x in ligands]).cast("array<string>"))
        return tuple(rows.where(F.col("entity") == entity).select(c.alias("c")).first()["c"])

    assert chosen("B", True, [], {"A": 7}) == ("B", 1)
    assert chosen("D", True, ["C", "none"], {"A": 7}) == ("C", 2)
    assert chosen("D", True, ["C", "A"], {"A": 7, "B": 6}) == ("A", 3)
    assert chosen("D, C", False, [], {"A": 7, "B": 7}) == ("C", 4)
    assert chosen(None, None, [], {"A": 0}) == ("A", 4)
    assert chosen("A", True, [], {"A": 0}, "n") == (None, None)


def test_segments_are_seen_where_gaps_leave_half(spark):
    seg = "array<struct<b:long,e:long>>"
    rows = spark.createDataFrame([(1, [(1, 10), (20, 29)], [(8, 9), (1, 5), (5, 6)]), (2, [(1, 10)] * 7, []), (3, [], None), (4, [(1, 10)], [(1, 5)])], f"i int, s {seg}, g {seg}")
    got = [tuple(r["c"]) for r in rows.select("i", structures.completeness(F.col("s"), F.col("g")).alias("c")).orderBy("i").collect()]
    assert got == [(1, 2, "INCOMPLETE_7TM"), (7, 7, "COMPLETE"), (0, 0, "UNKNOWN"), (1, 1, "INCOMPLETE_7TM")]
    regions = F.array(*[F.struct(F.lit(r).alias("ref_beg_seq_id"), F.lit(e).alias("entity_beg_seq_id"), F.lit(n).alias("length")) for r, e, n in ((1, 101, 10), (20, 5, 10), (90, 1, 5))])
    c = structures.aligned(F.struct(F.lit(5).alias("b"), F.lit(22).alias("e")), regions)
    assert [tuple(x) for x in spark.range(1).select(c.alias("c")).first()["c"]] == [(105, 110), (5, 7)]


def test_integrity_names_what_the_entry_contradicts(spark, entries):
    record = {
        "structure_info": {"method": "X-ray diffraction"},
        "receptor_info": {"uniprot_entry_name": "oprm", "chain_id": "A; Q"},
        "ligands": [{"chem_comp_id": "BAD", "chain_id": "apo", "pubchem_id": 12}, {"chem_comp_id": "n/a", "chain_id": None, "uniprot_entry_name": "No_one", "pubchem_id": "CID 5"}, {"pubchem_id": "x"}],
    }
    runs = spark.createDataFrame([(e, json.dumps(record)) for e in ("e", "n")], "entity string, t string").select("entity", F.parse_json("t").alias("v"))
    walked = tree.nodes(runs, ["entity"])
    known = spark.createDataFrame([("uniprot:no_one", False), ("pubchem:5", True)], "key string, found boolean")
    got = sorted(tuple(r) for r in structures.integrity(walked, entries, known).collect())
    always = [
        (".ligands[0]", "[API_UNAVAILABLE] at '.ligands[0]': Could not verify PubChem CID '12'."),
        (".ligands[1]", "Fake UniProt ID at '.ligands[1]': 'No_one' does not exist in UniProtKB."),
        (".ligands[2]", "Invalid PubChem CID at '.ligands[2]': 'x' does not exist in PubChem."),
        (".receptor_info", "Invalid Format at '.receptor_info': 'oprm' (Expected: name_species)"),
    ]
    only = [
        (".ligands[0]", "Ghost Ligand ID at '.ligands[0]': 'BAD' not found in PDB Metadata (valid: ['LIG', 'SO4'])."),
        (".receptor_info", "Ghost Chain at '.receptor_info': 'Q' not in PDB Source."),
        (".structure_info", "Method Conflict at 'structure_info': PDB says 'electron microscopy', AI says 'x-ray diffraction'."),
    ]
    assert got == sorted([("e", *x) for x in always + only] + [("n", *x) for x in always])
    assert structures.integrity(walked, entries).count() == 5


def test_tails_find_the_best_name(spark, entries):
    refs = spark.createDataFrame([("P63096", "MMCGLF"), ("P04899", "MMCGLF"), ("P63092", "MMYELL"), ("Q1", "AAXX")], "accession string, sequence string")
    got = {r["entity"]: tuple(r)[1:] for r in structures.tails(entries, refs).collect()}
    assert got["e"] == ("success", "gnai1_human", 4, "CGLF", ["gnai1_human", "gnai2_human"])
    assert got["n"] == ("no_g_protein_found", None, 0, None, [])
    none = {r["entity"]: r["status"] for r in structures.tails(entries, refs.limit(0)).collect()}
    assert none["e"] == "no_valid_comparisons"


@pytest.mark.parametrize(
    "text,alpha",
    [("Guanine nucleotide-binding protein G(i) subunit alpha-1", True), ("G protein subunit beta", False), ("mini-Gs", True), ("Mini-G s", True), ("miniG13", True), ("engineered G13", True), ("G protein Gq", True), ("Guanine nucleotide-binding protein G(q)", True), ("Nanobody 35", False), (None, False), ("", False)],
)
def test_alpha_descriptions(spark, text, alpha):
    assert spark.range(1).select(structures.is_alpha(F.lit(text).cast("string")).alias("a")).first()["a"] is alpha
