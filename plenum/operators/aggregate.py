"""From the runs of many entities to one checked record each: vote, best run, overwrite, checks, differences, report.

The steps follow one another as tables by entity, which is the only key: each ends in a checkpoint, as a record that
is rewritten many times in one plan makes expressions too large to plan. Differences are read off the record as the
checks leave it. Entities that can't be done are rows too, with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.functions.records import item_fields, patched
from plenum.functions.text import NULL_LIKE
from plenum.plans.tables import cut

from . import structures, tree

#: Names that take no part in votes, paths that have an authoritative source, and the fields by which
#: items of lists are known.
SOFT = ("note", "reasoning", "quote_or_path", "key_findings", "synonyms", "confidence")
TRUTH = ("structure_info.method", "structure_info.resolution", "structure_info.release_date")
KEYED = {"ligands": "chem_comp_id", "auxiliary_proteins": "name"}

#: Reasons of failures, and beginnings of messages about tails.
NO_RUNS, NO_ENTRY = "No valid AI runs found", "Enriched data not available"
ALIGNED, OVERRIDE, INVENTED, NOT_RUN = "[TIE-BREAKER ALIGNED]", "[TIE-BREAKER OVERRIDE]", "[HALLUCINATION ALERT]", "[ALGO WARNING]"

_LIGANDS = "struct<ligands:array<struct<name:string,type:string,chain_id:string,chem_comp_id:string>>>"
_RECEPTOR = "struct<receptor_info:struct<uniprot_entry_name:string,chain_id:string>>"


def failures(asked: DataFrame, runs: DataFrame, entries: DataFrame) -> DataFrame:
    """entity, error for each entity asked for that has no runs, or no entry; repeated ones once, null ones not at all."""
    here = asked.select("entity").where("entity IS NOT NULL").distinct()
    here = here.join(runs.select("entity").distinct().withColumn("r", F.lit(True)), "entity", "left").join(entries.select("entity").distinct().withColumn("c", F.lit(True)), "entity", "left")
    return here.withColumn("error", F.when(F.col("r").isNull(), NO_RUNS).when(F.col("c").isNull(), NO_ENTRY)).where("error IS NOT NULL").select("entity", "error")


def with_truth(v: Column, method: Column, resolution: Column, released: Column) -> Column:
    """A record whose structure_info has the values of its entry, as far as these are there."""
    return patched(v, "structure_info", {"method": F.when(method != "", method).cast("variant"), "resolution": resolution.cast("variant"), "release_date": F.when(released != "", released).cast("variant")})


def with_ligands(v: Column, chains: Column, components: Column) -> tuple[Column, Column]:
    """A record whose ligands have what their checks found, and the messages about ghosts."""
    found = structures.ligand_checks(F.from_json(F.to_json(v), _LIGANDS)["ligands"], chains, components)

    def fields(c: Column) -> dict[str, Column]:
        bound, small = c["status"] == "MATCHED_POLYMER", c["status"] == "MATCHED_SMALL_MOLECULE"
        nothing = F.parse_json(F.lit("null"))
        own = {name: F.when(small, F.coalesce(c[of].cast("variant"), nothing)) for name, of in (("InChIKey", "InChIKey"), ("api_pubchem_cid", "cid"), ("SMILES_stereo", "SMILES_stereo"), ("SMILES", "SMILES"))}
        return {"validation_status": c["status"].cast("variant"), "Sequence": F.when(bound, c["sequence"].cast("variant")), **own}

    return item_fields(v, "ligands", found, fields), F.filter(F.transform(found, lambda c: c["message"]), lambda m: m.isNotNull())


def with_receptor(v: Column, polymers: Column) -> tuple[Column, Column]:
    """A record whose receptor_info says whether its chains have the name it gives, and the message about a clash."""
    said = F.from_json(F.to_json(v), _RECEPTOR)["receptor_info"]
    found = structures.receptor_check(said["uniprot_entry_name"], said["chain_id"], polymers)
    made = {"validation_status": found["status"].cast("variant"), "api_reality": F.when(found["status"].isNotNull(), F.to_variant_object(found["reality"]))}
    return F.when(said.isNotNull(), patched(v, "receptor_info", made)).otherwise(v), F.array_compact(F.array(found["message"]))


def alpha_name(v: Column) -> Column:
    """The name a record gives its alpha subunit; null where it gives none."""
    name = F.try_variant_get(v, "$.signaling_partners.g_protein.alpha_subunit.uniprot_entry_name", "string")
    return F.when(name != "", name)


def tail_findings(said: Column, status: Column, best: Column, tail: Column, ties: Column) -> tuple[Column, Column]:
    """(conflicts, notes) of the tail's match against the name said; status null or ``skipped`` says nothing."""
    ties = F.when(F.size(ties) > 0, ties).otherwise(F.array_compact(F.array(best)))
    head = F.concat(F.lit(" at 'chimera_analysis': Tail '"), F.coalesce(tail, F.lit("N/A")), F.lit("' matched "), F.size(ties).cast("string"), F.lit(" slugs. AI "))
    good, known = status == "success", F.coalesce(F.array_contains(ties, said), F.lit(False))
    kept = F.when(good & said.isNotNull() & known, F.concat(F.lit(ALIGNED), head, F.lit("choice '"), said, F.lit("' retained.")))
    other = F.when(good & said.isNotNull() & ~known, F.concat(F.lit(OVERRIDE), head, F.lit("'"), said, F.lit("' failed. Defaulted to canonical '"), F.coalesce(best, F.lit("None")), F.lit("'.")))
    alone = F.when((status == "no_g_protein_found") & ~F.lower(said).isin(*NULL_LIKE), F.concat(F.lit(INVENTED + " at 'chimera_analysis': AI found '"), said, F.lit("' but algorithm found NO G-protein in source PDB.")))
    rest = F.when(~status.isin("success", "no_g_protein_found", "skipped"), F.concat(F.lit(NOT_RUN + " at 'chimera_analysis': Verification could not run. Status: '"), status, F.lit("'. Details: None")))
    matched = F.when(good & (best != ""), F.concat(F.lit("Matched G-alpha tail to '"), best, F.lit("'.")))
    return F.array_compact(F.array(other, alone, rest)), F.array_compact(F.array(kept, matched))


def aggregate(runs: DataFrame, context: DataFrame, asked: DataFrame | None = None, features: DataFrame | None = None, references: DataFrame | None = None, known: DataFrame | None = None) -> dict[str, DataFrame]:
    """records (entity, v), differences, reports and failures (entity, error) of all entities.

    runs: entity, ord (number), v (VARIANT). context: structures.entries. asked: entity, all of runs' where it isn't
    given. features: structures.features; without, no chain is known to be complete. references: accession, sequence;
    without, tails are skipped. known: as structures.integrity takes it; without, names aren't looked up.
    reports: entity, critical, conflicts, notes (arrays in order), score, status. Records that are no objects count as
    corrupt runs and don't take part; an entry that stands twice gives two records.
    """
    runs = runs.where(F.schema_of_variant("v").startswith("OBJECT"))
    asked = asked if asked is not None else runs.select("entity")
    here = runs.join(context.select("entity").distinct(), "entity", "left_semi")
    votes, _, major = tree.polled(here, "entity", "ord", keyed=KEYED, soft=SOFT)
    major, context = cut(major), cut(context)
    best = tree.best_record(here, major, "entity", "ord").join(context, "entity")
    best = cut(best.withColumn("v", with_truth(F.col("v"), F.col("method"), F.col("resolution"), F.col("release_date"))))
    v, ghosts = with_ligands(F.col("v"), F.col("chains"), F.col("components"))
    best = cut(best.withColumns({"ghosts": ghosts, "v": v}))
    v, clash = with_receptor(F.col("v"), F.col("polymers"))
    best = cut(best.withColumns({"clash": clash, "v": v}))
    best = cut(structures.with_oligomer(best, features))
    records = best.select("entity", "v")
    differ = tree.differences(records, major, votes, "entity", keyed=KEYED, soft=SOFT, excluded=TRUTH)
    wrong = structures.integrity(tree.nodes(records, ["entity"]), context, known).groupBy("entity").agg(F.array_sort(F.collect_list("message")).alias("wrong"))
    none = F.lit(None).cast("string")
    matched = structures.tails(context, references) if references is not None else context.select("entity", F.lit("skipped").alias("status"), none.alias("best"), F.lit(0).alias("score"), none.alias("tail"), F.array().cast("array<string>").alias("ties"))
    rows = best.select("entity", "ghosts", "clash", alpha_name(F.col("v")).alias("said")).join(wrong, "entity", "left").join(matched, "entity", "left")
    conflicts, notes = tail_findings(F.col("said"), F.col("status"), F.col("best"), F.col("tail"), F.col("ties"))
    critical = F.concat("ghosts", "clash", F.coalesce("wrong", F.array().cast("array<string>")))
    reports = rows.select("entity", critical.alias("critical"), conflicts.alias("conflicts"), notes.alias("notes"), F.coalesce("score", F.lit(0)).cast("long").alias("score"), F.coalesce("status", F.lit("skipped")).alias("status"))
    return {"records": records, "differences": differ, "reports": reports, "failures": failures(asked, runs, context)}
