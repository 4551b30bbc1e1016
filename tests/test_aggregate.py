"""Entities from their runs to checked records, with reports, differences and failures."""

import json

import pytest
from pyspark.sql import functions as F

from plenum.operators import aggregate, structures


def polymer(chains, slugs, seq="MKT", description="", accessions=None, labels=None):
    instances = [{"rcsb_polymer_entity_instance_container_identifiers": {"auth_asym_id": c, "asym_id": (labels or {}).get(c)}} for c in chains]
    return {
        "rcsb_polymer_entity": {"pdbx_description": description},
        "rcsb_polymer_entity_container_identifiers": {"auth_asym_ids": list(chains)},
        "entity_poly": {"pdbx_seq_one_letter_code_can": seq},
        "uniprots": [{"rcsb_id": a, "x_entry_name_slug": s} for a, s in zip(accessions or [f"P{i}" for i in range(len(slugs))], slugs, strict=True)],
        "polymer_entity_instances": instances,
    }


ENTRY = {
    "exptl": [{"method": "ELECTRON MICROSCOPY"}],
    "em_3d_reconstruction": [{"resolution": 2.5}],
    "rcsb_accession_info": {"initial_release_date": "2024-02-07T00:00:00Z"},
    "assemblies": [None, {"rcsb_struct_symmetry": [{"oligomeric_state": "Monomer", "kind": "Global Symmetry", "stoichiometry": ["A1"]}]}],
    "polymer_entities": [polymer("R", ["oprm_human"], labels={"R": "A"}), polymer("G", ["gnai1_human"], "XXCGLF", "G alpha i")],
    "nonpolymer_entities": [{"nonpolymer_comp": {"chem_comp": {"id": "LIG", "name": "n"}, "rcsb_chem_comp_descriptor": {"InChIKey": "K"}}}],
}


def run(chain="G", name="gnai1_human", ligand="LIG", method="x-ray", note=None):
    return {"structure_info": {"method": method, "state": {"value": "active"}}, "receptor_info": {"chain_id": chain, "uniprot_entry_name": name, "note": note}, "ligands": [{"chem_comp_id": ligand, "name": "L", "type": "small", "chain_id": "R"}], "signaling_partners": {"g_protein": {"alpha_subunit": {"uniprot_entry_name": "gnas2_human"}}}}


@pytest.fixture(scope="module")
def made(spark):
    runs = [("e", 0, run(note="n")), ("e", 1, run(method="em")), ("e", 2, run("R", "oprm_human", "ABC")), ("e", 3, ["no object"]), ("noentry", 0, run()), ("odd", 0, {"a": None}), ("odd", 1, {"structure_info": "text", "ligands": "none"})]
    docs = [("e", {"data": {"entry": ENTRY}}), ("odd", {"data": {"entry": {}}}), ("lost", {"data": {"entry": {}}})]
    seen = {"rcsb_polymer_entity_feature": [{"type": "membrane", "feature_positions": [{"beg_seq_id": 10 * i + 1, "end_seq_id": 10 * i + 8} for i in range(7)]}], "polymer_entity_instances": [{"rcsb_polymer_entity_instance_container_identifiers": {"auth_asym_id": "R"}, "rcsb_polymer_instance_feature": [{"type": "UNMODELED", "feature_positions": [{"beg_seq_id": 1, "end_seq_id": 6}]}]}]}

    def frame(rows, *names):
        return spark.createDataFrame([(*r[:-1], json.dumps(r[-1])) for r in rows], ", ".join(names) + ", t string").withColumn("v", F.parse_json("t")).drop("t")

    context = structures.entries(frame(docs, "entity string"), "x")
    found = structures.features(frame([("e", {"data": {"entry": {"polymer_entities": [seen]}}})], "entity string"))
    references = spark.createDataFrame([("P63092", "AAYELL"), ("P63096", "AACGLF")], "accession string, sequence string")
    asked = spark.createDataFrame([("e",), ("noentry",), ("odd",), ("lost",), ("lost",), (None,)], "entity string")
    return {k: [r.asDict(True) for r in d.collect()] for k, d in aggregate.aggregate(frame(runs, "entity string", "ord long"), context, asked, found, references).items() for d in [d.withColumn("v", F.to_json("v")) if k == "records" else d]}


def test_failures_have_their_reason(made):
    assert sorted((r["entity"], r["error"]) for r in made["failures"]) == [("lost", "No valid AI runs found"), ("noentry", "Enriched data not available")]


def test_records_are_overwritten_checked_and_corrected(made):
    records = {r["entity"]: json.loads(r["v"]) for r in made["records"]}
    assert set(records) == {"e", "odd"}
    e = records["e"]
    assert e["structure_info"] == {"method": "ELECTRON MICROSCOPY", "resolution": 2.5, "release_date": "2024-02-07", "state": {"value": "active"}}
    assert e["ligands"] == [{"chem_comp_id": "LIG", "name": "L", "type": "small", "chain_id": "R", "validation_status": "MATCHED_SMALL_MOLECULE", "InChIKey": "K", "SMILES": None, "SMILES_stereo": None, "api_pubchem_cid": None}]
    # the chain that most runs give is the G protein's: it becomes the receptor's, after the check of the name
    assert e["receptor_info"] == {"chain_id": "R", "uniprot_entry_name": "oprm_human", "note": "n", "validation_status": "RECEPTOR_MATCH", "api_reality": ["gnai1_human"]}
    o = e["oligomer_analysis"]
    assert o["classification"] == "MONOMER" and o["label_asym_id_map"] == {"R": "A"} and o["assembly_cross_check"]["oligomeric_state"] == "Monomer"
    assert o["all_gpcr_chains"] == [{"chain_id": "R", "slug": "oprm_human", "7tm_status": "COMPLETE", "resolved_tms": 6, "total_tms": 7}]
    assert o["primary_protomer_suggestion"]["chain_id"] == "R" and o["chain_id_override"]["trigger"] == "HALLUCINATION"
    assert [a["type"] for a in o["alerts"]] == ["HALLUCINATION", "CHAIN_ID_OVERRIDDEN"] and "['G'] which are NOT" in o["alerts"][0]["message"]
    odd = records["odd"]
    assert odd["oligomer_analysis"]["classification"] == "NO_GPCR" and "receptor_info" not in odd


def test_differences_follow_the_corrections(made):
    found = {(r["path"], r["best_value"], r["majority_value"], r["n"]) for r in made["differences"] if r["entity"] == "e"}
    assert found == {("receptor_info.chain_id", '"R"', '"G"', 2), ("receptor_info.uniprot_entry_name", '"oprm_human"', '"gnai1_human"', 2)}


def test_reports_say_what_is_wrong(made):
    report = next(r for r in made["reports"] if r["entity"] == "e")
    assert report["critical"] == [] and (report["score"], report["status"]) == (4, "success")
    assert report["conflicts"] == ["[TIE-BREAKER OVERRIDE] at 'chimera_analysis': Tail 'CGLF' matched 1 slugs. AI 'gnas2_human' failed. Defaulted to canonical 'gnai1_human'."]
    assert report["notes"] == ["Matched G-alpha tail to 'gnai1_human'."]
    odd = next(r for r in made["reports"] if r["entity"] == "odd")
    assert odd["status"] == "no_g_protein_found" and odd["conflicts"] == []


def test_tail_findings_of_every_status(spark):
    rows = [("a", "success", "a", "T", ["a", "b"]), ("c", "success", "a", "T", ["a"]), (None, "success", "a", "T", ["a"]), ("c", "no_g_protein_found", None, None, []), ("none", "no_g_protein_found", None, None, []), ("c", "sequence_too_short", None, None, []), ("c", "skipped", None, None, []), ("c", None, None, None, None)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, said string, status string, best string, tail string, ties array<string>")
    conflicts, notes = aggregate.tail_findings(*[F.col(c) for c in ("said", "status", "best", "tail", "ties")])
    got = [(r["c"], r["n"]) for r in frame.select("i", conflicts.alias("c"), notes.alias("n")).orderBy("i").collect()]
    assert [len(c) for c, _ in got] == [0, 1, 0, 1, 0, 1, 0, 0] and [len(n) for _, n in got] == [2, 1, 1, 0, 0, 0, 0, 0]
    assert got[0][1][0] == "[TIE-BREAKER ALIGNED] at 'chimera_analysis': Tail 'T' matched 2 slugs. AI choice 'a' retained."


def test_segments_come_from_accessions_where_the_entity_has_none(spark):
    one = {"uniprots": [{"rcsb_id": "P1", "rcsb_uniprot_feature": [{"type": "TRANSMEMBRANE", "feature_positions": [{"beg_seq_id": 5, "end_seq_id": 20}]}, {"type": "TOPOLOGICAL_DOMAIN", "description": "outside", "feature_positions": [{"beg_seq_id": 1, "end_seq_id": 4}]}]}, None], "rcsb_polymer_entity_align": [{"reference_database_name": "UniProt", "reference_database_accession": "P1", "aligned_regions": [{"ref_beg_seq_id": 10, "entity_beg_seq_id": 100, "length": 50}]}], "polymer_entity_instances": [{"rcsb_polymer_entity_instance_container_identifiers": {"auth_asym_id": "A"}}, {"rcsb_polymer_entity_instance_container_identifiers": {"auth_asym_id": None}}]}
    docs = spark.createDataFrame([("e", json.dumps({"data": {"entry": {"polymer_entities": [one, None]}}})), ("n", "{}")], "entity string, t string").withColumn("v", F.parse_json("t"))
    (row,) = structures.features(docs).collect()
    assert (row["chain"], [tuple(s) for s in row["segments"]], row["gaps"], [tuple(p) for p in row["proteins"]]) == ("A", [(100, 110)], [], [("P1", 1)])
