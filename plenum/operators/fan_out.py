"""Fan-out of one accepted record to the flat tables it fills, with the chain, the note and the labels they need.

All tables come from one parse of the record; each is a projection or one explode, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.functions.text import capitalized, sanitized

_SUBUNIT = "struct<uniprot_entry_name:string,chain_id:string>"
RECORD = f"""struct<structure_info:struct<method:string,resolution:double,release_date:string,state:struct<value:string>,note:string>,
    receptor_info:struct<uniprot_entry_name:string,chain_id:string>,
    ligands:array<struct<name:string,chain_id:string,type:string,pubchem_id:string,role:struct<value:string>,SMILES:string,SMILES_stereo:string,InChIKey:string,Sequence:string>>,
    signaling_partners:struct<g_protein:struct<alpha_subunit:{_SUBUNIT},beta_subunit:{_SUBUNIT},gamma_subunit:{_SUBUNIT},note:string>,
        arrestin:struct<uniprot_entry_name:string,chain_id:string,note:string>>,
    auxiliary_proteins:array<struct<name:string,type:struct<value:string>>>,
    oligomer_analysis:struct<classification:string,all_gpcr_chains:array<struct<chain_id:string,slug:string>>,label_asym_id_map:map<string,string>,
        primary_protomer_suggestion:struct<chain_id:string,reason:string>,alerts:array<struct<type:string,message:string>>,
        chain_id_override:struct<applied:boolean,original_chain_id:string,corrected_chain_id:string,trigger:string>>>"""

#: The tables of proteins besides the receptor and its partners, by their kind.
AUXILIARY = {
    "Fusion protein": "fusion_proteins",
    "Nanobody": "nanobodies",
    "GRK": "grk",
    "RAMP": "ramp",
    "MRAP": "ramp",
    "Antibody": "antibodies",
    "Antibody fab fragment": "antibodies",
    "scFv": "scfv",
    "Other": "other_aux_proteins",
}


def _items(chains: Column) -> Column:
    return F.filter(F.transform(F.split(chains, ","), lambda x: F.trim(x)), lambda x: x != "")


def _labels(chains: Column, names: Column) -> Column:
    """A comma list of chains by their labels; a chain without one keeps its name."""
    of = F.transform(F.split(chains, ","), lambda c: F.coalesce(F.try_element_at(names, F.trim(c)), F.trim(c)))
    return F.when(chains == "", "").otherwise(F.coalesce(F.array_join(of, ", "), chains))


def _label_map(oligo: Column) -> Column:
    return F.coalesce(oligo["label_asym_id_map"], F.create_map().cast("map<string,string>"))


def ligand_chains(ligands: Column) -> Column:
    """The distinct chains that ligands are on."""
    stated = F.filter(F.transform(F.coalesce(ligands, F.array()), lambda g: g["chain_id"]), lambda c: ~F.lower(F.trim(c)).isin("", "none", "null", "n/a"))
    return F.array_distinct(F.flatten(F.transform(stated, _items)))


#: The wording of the notes in truncated() and note().


def truncated(chain: Column, name: Column, oligo: Column, bound: Column) -> Column:
    """chain, name and note: of several chains the suggested one, its own name, and which ligands are left behind."""
    one = oligo["primary_protomer_suggestion"]["chain_id"]
    cut = F.coalesce(F.contains(chain, F.lit(",")) & (one != ""), F.lit(False))
    own = F.get(F.filter(oligo["all_gpcr_chains"], lambda c: c["chain_id"] == one), F.lit(0))["slug"]
    reason = oligo["primary_protomer_suggestion"]["reason"]
    orphans = F.array_sort(F.array_intersect(bound, F.array_remove(F.transform(F.split(chain, ","), lambda c: F.trim(c)), one)))
    alert = F.when(F.size(orphans) > 0, F.concat(F.lit(" [WARNING: Ligands are bound to truncated chains "), F.array_join(orphans, ", "), F.lit("!]"))).otherwise("")
    note = F.concat(
        F.lit("[DB TRUNCATION: AI correctly identified chains "), chain, F.lit(", but DB requires 1. Auto-selected primary chain "), one,
        F.lit(" based on: "), F.when(reason != "", reason).otherwise("No reason provided"), F.lit("]"), alert,
    )
    return F.struct(F.when(cut, one).otherwise(chain).alias("chain"), F.when(cut & (own != ""), own).otherwise(name).alias("name"), F.when(cut, note).alias("note"))


def note(base: Column, oligo: Column, truncation: Column) -> Column:
    """The note of a structure: its own, a corrected chain, several chains, alerts and the truncation, as far as there are any."""
    over = oligo["chain_id_override"]
    shown = [F.coalesce(over[f], F.lit("None")) for f in ("original_chain_id", "corrected_chain_id", "trigger")]
    corrected = F.when(over["applied"], F.concat(F.lit("[CHAIN CORRECTED: "), shown[0], F.lit(" -> "), shown[1], F.lit(", reason: "), shown[2], F.lit("]")))
    kind = oligo["classification"]
    names = F.transform(F.coalesce(oligo["all_gpcr_chains"], F.array()), lambda c: F.when(c["chain_id"] != "", c["chain_id"]).otherwise("?"))
    several = F.when(kind.isin("HOMOMER", "HETEROMER"), F.concat(F.lit("["), kind, F.lit(": chains "), F.array_join(names, ", "), F.lit("]")))
    told = F.filter(oligo["alerts"], lambda a: a["type"].isin("HALLUCINATION", "MISSED_PROTOMER"))
    alerts = F.array_join(F.transform(told, lambda a: F.concat(F.lit("["), a["type"], F.lit(": "), F.coalesce(a["message"], F.lit("")), F.lit("]"))), " ")
    parts = F.array(F.trim(base), corrected, several, alerts, truncation)
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (p != "")), " ")


def tables(records: DataFrame, v: str = "v") -> dict[str, DataFrame]:
    """The rows of all tables by name, in the columns of their files, from records (entity, v VARIANT).

    One row of structures and any number of ligands and auxiliary proteins per record; one of g_proteins and
    arrestins where that partner is an object with fields. Null and absent values are empty texts; auxiliary
    proteins of an unknown kind or without one go to the table of other ones. Records that aren't objects give
    nothing; tables without rows are empty. A resolution is written as a decimal, whole numbers with .0, since VARIANT
    makes no difference between 3 and 3.0.
    """
    has = {p: F.coalesce(F.to_json(F.try_variant_get(v, f"$.signaling_partners.{p}", "variant")).rlike(r"^\{."), F.lit(False)) & (F.to_json(F.try_variant_get(v, f"$.signaling_partners.{p}", "variant")) != "{}") for p in ("g_protein", "arrestin")}
    d = records.where(F.schema_of_variant(v).startswith("OBJECT")).select(F.col("entity").alias("PDB"), F.from_json(F.to_json(v), RECORD).alias("r"), *[c.alias(f"has_{p}") for p, c in has.items()])
    d = d.select("*", "r.*").drop("r").withColumn("names", _label_map(F.col("oligomer_analysis")))
    labels = F.col("names")
    date = sanitized(F.col("structure_info.release_date")).alias("Date")

    cut = truncated(sanitized(F.col("receptor_info.chain_id")), sanitized(F.col("receptor_info.uniprot_entry_name")), F.col("oligomer_analysis"), ligand_chains(F.col("ligands")))
    s = d.withColumn("cut", cut)
    out = {
        "structures": s.select(
            "PDB", F.col("cut.name").alias("Receptor_UniProt"), sanitized(F.col("structure_info.method")).alias("Method"), sanitized(F.col("structure_info.resolution")).alias("Resolution"),
            capitalized(sanitized(F.col("structure_info.state.value"))).alias("State"), F.col("cut.chain").alias("ChainID"), _labels(F.col("cut.chain"), labels).alias("label_asym_id"),
            note(F.col("structure_info.note"), F.col("oligomer_analysis"), F.col("cut.note")).alias("Note"), date,
        )
    }

    g = d.select("PDB", "names", date, F.explode(F.filter("ligands", lambda x: x.isNotNull())).alias("g"))
    smiles = F.when(F.col("g.SMILES_stereo") != "", F.col("g.SMILES_stereo")).otherwise(F.col("g.SMILES"))
    texts = {n: sanitized(F.col(f"g.{f}")) for n, f in (("ChainID", "chain_id"), ("Name", "name"), ("PubChemID", "pubchem_id"), ("Role", "role.value"), ("Title", "name"), ("Type", "type"), ("InChIKey", "InChIKey"), ("Sequence", "Sequence"))}
    texts |= {"label_asym_id": _labels(texts["ChainID"], labels), "Date": F.col("Date"), "In structure": F.lit(""), "SMILES": sanitized(smiles)}
    order = ("ChainID", "label_asym_id", "Name", "PubChemID", "Role", "Title", "Type", "Date", "In structure", "SMILES", "InChIKey", "Sequence")
    out["ligands"] = g.select("PDB", *[texts[n].alias(n) for n in order])

    units = []
    for unit in ("alpha", "beta", "gamma"):
        one, chain = f"signaling_partners.g_protein.{unit}_subunit", sanitized(F.col(f"signaling_partners.g_protein.{unit}_subunit.chain_id"))
        units += [c.alias(f"{unit.capitalize()}_{n}") for n, c in (("UniProt", sanitized(F.col(f"{one}.uniprot_entry_name"))), ("ChainID", chain), ("label_asym_id", _labels(chain, labels)))]
    out["g_proteins"] = d.where("has_g_protein").select("PDB", *units, sanitized(F.col("signaling_partners.g_protein.note")).alias("Note"))
    chain = sanitized(F.col("signaling_partners.arrestin.chain_id"))
    out["arrestins"] = d.where("has_arrestin").select("PDB", sanitized(F.col("signaling_partners.arrestin.uniprot_entry_name")).alias("UniProt"), chain.alias("ChainID"), _labels(chain, labels).alias("label_asym_id"), sanitized(F.col("signaling_partners.arrestin.note")).alias("Note"))

    a = d.select("PDB", F.explode(F.filter("auxiliary_proteins", lambda x: x.isNotNull())).alias("a"))
    kinds = F.create_map(*[F.lit(x) for pair in AUXILIARY.items() for x in pair])
    a = a.select("PDB", sanitized(F.col("a.name")).alias("Name"), F.coalesce(F.try_element_at(kinds, F.coalesce("a.type.value", F.lit("Other"))), F.lit(AUXILIARY["Other"])).alias("target"))
    for target in dict.fromkeys(AUXILIARY.values()):
        out[target] = a.where(F.col("target") == target).select("PDB", "Name")
    return out
