"""Records become rows of flat tables."""

import json

from pyspark.sql import functions as F

from plenum.operators import fan_out

FULL = {
    "structure_info": {"method": "EM", "resolution": 3.0, "release_date": "2024-01-02", "state": {"value": "ACTIVE"}, "note": " seen "},
    "receptor_info": {"uniprot_entry_name": "a_human", "chain_id": "A, B"},
    "ligands": [{"name": "L", "chain_id": "B,C", "SMILES": "CC", "SMILES_stereo": "", "pubchem_id": "5", "role": None, "type": "x"}, {"name": None, "chain_id": "None"}],
    "signaling_partners": {"g_protein": {"alpha_subunit": {"uniprot_entry_name": "g", "chain_id": "C"}, "note": "n"}, "arrestin": {}},
    "auxiliary_proteins": [{"name": "n1", "type": {"value": "Nanobody"}}, {"name": "n2", "type": {"value": "MRAP"}}, {"name": "n3", "type": None}, {"name": "n4", "type": {"value": "new kind"}}],
    "oligomer_analysis": {
        "classification": "HOMOMER",
        "all_gpcr_chains": [{"chain_id": "A", "slug": "a2_human"}, {"chain_id": "B"}],
        "label_asym_id_map": {"A": "R", "C": "T"},
        "primary_protomer_suggestion": {"chain_id": "A", "reason": "why"},
        "alerts": [{"type": "MISSED_PROTOMER", "message": "m"}, {"type": "CONFIRMED_OLIGOMER", "message": "no"}],
        "chain_id_override": {"applied": True, "original_chain_id": "Z", "corrected_chain_id": "A", "trigger": "t"},
    },
}


def test_a_record_fills_its_tables(spark):
    given = [("F", FULL), ("E", {}), ("N", {"ligands": None, "receptor_info": None, "signaling_partners": {"arrestin": {"chain_id": None}}}), ("X", [1])]
    records = spark.createDataFrame([(e, json.dumps(r)) for e, r in given], "entity string, t string").select("entity", F.parse_json("t").alias("v"))
    made = fan_out.tables(records)
    got = {k: sorted(tuple(r) for r in df.collect()) for k, df in made.items()}
    note = "seen [CHAIN CORRECTED: Z -> A, reason: t] [HOMOMER: chains A, B] [MISSED_PROTOMER: m] [DB TRUNCATION: AI correctly identified chains A, B, but DB requires 1. Auto-selected primary chain A based on: why] [WARNING: Ligands are bound to truncated chains B!]"
    assert got["structures"] == [("E", *[""] * 8), ("F", "a2_human", "EM", "3.0", "Active", "A", "R", note, "2024-01-02"), ("N", *[""] * 8)]
    assert got["ligands"] == [("F", "B,C", "B, T", "L", "5", "", "L", "x", "2024-01-02", "", "CC", "", ""), ("F", "None", "None", "", "", "", "", "", "2024-01-02", "", "", "", "")]
    assert got["g_proteins"] == [("F", "g", "C", "T", "", "", "", "", "", "", "n")]
    assert got["arrestins"] == [("N", "", "", "", "")]
    assert {k: v for k, v in got.items() if v and k not in ("structures", "ligands", "g_proteins", "arrestins")} == {"nanobodies": [("F", "n1")], "ramp": [("F", "n2")], "other_aux_proteins": [("F", "n3"), ("F", "n4")]}
    assert len(made) == 11
