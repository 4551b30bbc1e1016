"""What remains to be fetched or asked for, and the state that fetching leaves an entry in.

Responses are tables that were captured beforehand: the engine decides on them and makes no requests itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.functions.records import written
from plenum.plans.tables import cut

from .reference import waterfall
from .structures import BUFFERS


def _given(c: Column) -> Column:
    return c.isNotNull() & (c.cast("string") != "")


def paper_status(df: DataFrame, force: bool = False) -> DataFrame:
    """df with ``status`` and ``source``: what became of an entry's paper, by the first rule that holds.

    Columns: has_entry, has_file, readable, contact (booleans), doi, pmid, pmcid, open_url, archive_url, abstract
    (texts), file_ok (whether what was downloaded is a paper). An open copy goes before the archive's, which needs
    a pmcid; without either an abstract is kept. Null booleans are false, empty texts are missing.
    """
    c = F.col
    opened, archived = _given(c("open_url")), _given(c("pmcid")) & _given(c("archive_url"))
    rules = (
        (~F.coalesce(c("has_entry"), F.lit(False)), "skipped_no_enriched_data"),
        (c("has_file") & F.lit(not force), "skipped_already_downloaded"),
        (~F.coalesce(c("readable") & c("contact"), F.lit(False)), "failed_no_data"),
        (~_given(c("doi")), "failed_no_doi"),
        ((opened | archived) & c("file_ok"), "success_pdf_downloaded"),
        (_given(c("pmid")) & _given(c("abstract")), "fallback_abstract_only"),
    )
    status = waterfall(*rules, default="fallback_paywalled")
    source = F.when(c("status") == "success_pdf_downloaded", F.when(opened, "unpaywall_pdf").otherwise("ncbi_pmc_oa_pdf")).when(c("status") == "fallback_abstract_only", "ncbi_abstract")
    return df.withColumn("status", status).withColumn("source", source)


def after_arrival(log: DataFrame, arrived: DataFrame, key: str) -> DataFrame:
    """The current rows of a log (key, status) in which paywalled papers that a user brought are marked as such."""
    came = arrived.select(key).distinct().withColumn("__came", F.lit(True))
    status = F.when((F.col("status") == "fallback_paywalled") & F.col("__came"), "manual_user_provided").otherwise(F.col("status"))
    return log.join(came, key, "left").withColumn("status", status).drop("__came")


def requests(targets: DataFrame, done: DataFrame, key: str, runs: int) -> DataFrame:
    """key, run of all runs 1 to ``runs`` of the targets that aren't done yet; done: key, run. Repeated targets count once."""
    wanted = targets.select(key).where(F.col(key).isNotNull()).distinct().withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(runs))))
    return wanted.join(done.select(key, F.col("run").cast("int").alias("run")).distinct(), [key, "run"], "left_anti")


def siblings(entries: DataFrame, papers: DataFrame, key: str, paper: str) -> DataFrame:
    """key, siblings: the other entries of an entry's paper, sorted; papers: paper, ids. Without a paper an empty list.

    The list of a paper is built once and looked up, so entries of one paper aren't paired.
    """
    found = entries.select(key, paper).join(papers.select(paper, "ids"), paper, "left")
    return found.select(key, F.array_sort(F.array_distinct(F.coalesce(F.filter("ids", lambda x: x.isNotNull() & (x != F.col(key))), F.array().cast(papers.schema["ids"].dataType)))).alias("siblings"))


def sequence_of(fasta: Column) -> Column:
    """The sequence of a FASTA text: all lines but the first, joined; null where there is none."""
    lines = F.split(F.trim(fasta), r"\r?\n")
    text = F.array_join(F.transform(F.slice(lines, 2, 1 << 30), lambda x: F.trim(x)), "")
    return F.when(text != "", text)


def component_kind(weight: Column, limit: float = 900.0) -> Column:
    """What a component's weight says: a small molecule, a peptide, or unknown where it is no number."""
    w = weight.try_cast("double")
    return F.when(w.isNull(), "unknown").when(w < limit, "small-molecule").otherwise("peptide")


def page_facts(html: Column, url: Column) -> Column:
    """title, link and host of a captured page; empty where there is none."""
    return F.struct(F.regexp_extract(html, "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract(html, 'href="([^"]*)"', 1).alias("link"), F.regexp_extract(url, "^https?://([^/]+)", 1).alias("host"))


def named(entries: DataFrame, names: DataFrame, mark: str) -> DataFrame:
    """Entry documents (entity, v) in which accessions have the names that a captured table (accession, name) gives them.

    Every distinct accession is looked up once, and documents meet their names by entity. Accessions without a name
    stay as they are; of several names the smallest counts. Documents without entities stay whole.
    """
    pattern = r'"rcsb_id":"([^"]+)"'
    asked = entries.select("entity", F.explode(F.array_distinct(F.regexp_extract_all(F.to_json("v"), F.lit(pattern), F.lit(1)))).alias("accession"))
    one = names.where("accession IS NOT NULL AND name <> ''").groupBy("accession").agg(F.min("name").alias("name"))
    per = asked.join(one, "accession").groupBy("entity").agg(F.map_from_entries(F.collect_list(F.struct("accession", "name"))).alias("names"))
    field, text = f"{mark}_entry_name_slug", F.to_json("v")

    def polymer(p):
        units = F.try_variant_get(p, "$.uniprots", "array<variant>")

        def unit(u):
            name = F.try_element_at(F.col("names"), F.try_variant_get(u, "$.rcsb_id", "string"))
            return F.when(name.isNotNull(), written(u, {field: name.cast("variant")})).otherwise(u)

        return F.when(units.isNotNull(), written(p, {"uniprots": F.to_variant_object(F.transform(units, unit))})).otherwise(p)

    polymers = F.try_variant_get("v", "$.data.entry.polymer_entities", "array<variant>")
    whole = _entry_with(F.col("v"), {"polymer_entities": F.to_variant_object(F.transform(polymers, polymer))})
    rows = entries.join(per, "entity", "left")
    return rows.withColumn("v", F.when(F.col("names").isNotNull() & polymers.isNotNull() & text.contains('"uniprots"'), whole).otherwise(F.col("v"))).drop("names")


def _entry_with(v: Column, made: dict[str, Column]) -> Column:
    """An entry document with fields (VARIANTs) of its entry written; a document without an entry stays as it is."""
    data, entry = F.try_variant_get(v, "$.data", "variant"), F.try_variant_get(v, "$.data.entry", "variant")
    whole = written(v, {"data": written(data, {"entry": written(entry, made)})})
    return F.when(F.schema_of_variant(entry).startswith("OBJECT"), whole).otherwise(v)


def identified(entries: DataFrame, compounds: DataFrame, descriptors: DataFrame, mark: str) -> DataFrame:
    """Entry documents (entity, v) whose components have their kind by weight, and what captured tables know of them.

    compounds: key (an InChIKey), cid, synonyms. descriptors: code, SMILES, SMILES_stereo, InChIKey; of buffers and
    ions nothing is taken, and an InChIKey that is there stays. Of several rows of a key the smallest counts. What
    nobody knows is null, synonyms an empty list. Keys and codes are looked up once each.
    """
    paths = "$.data.entry.nonpolymer_entities"
    parts = F.try_variant_get("v", paths, "array<variant>")

    def field(c, path):
        return F.try_variant_get(c, f"$.nonpolymer_comp.{path}", "string")

    key, code, weight = "rcsb_chem_comp_descriptor.InChIKey", "chem_comp.id", "chem_comp.formula_weight"
    asked = entries.select("entity", F.explode(F.array_distinct(F.transform(parts, lambda c: F.struct(field(c, key).alias("key"), field(c, code).alias("code"))))).alias("a")).select("entity", "a.*")
    known = compounds.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("cid", "synonyms")).alias("c"))
    shapes = descriptors.where(F.col("code").isNotNull() & ~F.col("code").isin(*BUFFERS)).groupBy("code").agg(F.min(F.struct("SMILES", "SMILES_stereo", "InChIKey")).alias("d"))
    met = asked.join(known, "key", "left").join(shapes, "code", "left").where("c IS NOT NULL OR d IS NOT NULL")
    per = met.groupBy("entity").agg(F.collect_list(F.struct("key", "code", "c", "d")).alias("met"))

    def beside(c):
        return F.struct(c.alias("c"), F.get(F.filter("met", lambda m: m["key"].eqNullSafe(field(c, key)) & m["code"].eqNullSafe(field(c, code))), F.lit(0)).alias("m"))

    def one(x):
        c, mine = x["c"], x["m"]
        comp, old = F.try_variant_get(c, "$.nonpolymer_comp", "variant"), F.try_variant_get(c, "$.nonpolymer_comp.rcsb_chem_comp_descriptor", "variant")
        nothing = F.parse_json(F.lit("null"))
        names = F.coalesce(mine["c"]["synonyms"], F.array().cast("array<string>"))
        own = {f"{mark}_determined_type": component_kind(field(c, weight)).cast("variant"), f"{mark}_pubchem_cid": F.coalesce(mine["c"]["cid"].cast("variant"), nothing), f"{mark}_pubchem_synonyms": F.to_variant_object(names)}
        shape = mine["d"]
        drawn = {n: F.when(shape.isNotNull(), F.coalesce(shape[n].cast("variant"), nothing)) for n in ("SMILES", "SMILES_stereo")}
        drawn["InChIKey"] = F.when(shape.isNotNull() & (F.coalesce(field(c, key), F.lit("")) == ""), shape["InChIKey"].cast("variant"))
        own["rcsb_chem_comp_descriptor"] = F.when(F.schema_of_variant(old).startswith("OBJECT"), written(old, drawn))
        return F.when(F.schema_of_variant(comp).startswith("OBJECT"), written(c, {"nonpolymer_comp": written(comp, own)})).otherwise(c)

    rows = entries.join(per, "entity", "left").withColumn("met", F.coalesce("met", F.array().cast(per.schema["met"].dataType)))
    return rows.withColumn("v", F.when(parts.isNotNull(), _entry_with(F.col("v"), {"nonpolymer_entities": F.to_variant_object(F.transform(F.transform(parts, beside), one))})).otherwise(F.col("v"))).drop("met")


def enriched(docs: DataFrame, done: DataFrame, names: DataFrame, compounds: DataFrame, descriptors: DataFrame, papers: DataFrame, mark: str) -> DataFrame:
    """entity, v of the documents that aren't done yet, with names of accessions, components' ids and siblings.

    papers: entity, siblings (as siblings() gives them). Each step ends in a checkpoint, as it rewrites the document.
    """
    fresh = docs.join(done.select("entity").distinct(), "entity", "left_anti")
    known = cut(identified(cut(named(fresh, names, mark)), compounds, descriptors, mark))
    rows = known.join(papers.groupBy("entity").agg(F.first("siblings").alias("siblings")), "entity", "left")
    some = F.when(F.size("siblings") > 0, F.to_variant_object("siblings"))
    return rows.select("entity", _entry_with(F.col("v"), {"sibling_pdbs": some}).alias("v"))


def inventory(entity: Column, polymers: Column) -> Column:
    """The text that lists an entry's chains by description, in order of first mention. Fixed wording; polymers have description and listed."""
    kinds = F.array_distinct(F.transform(polymers, lambda p: F.when(p["description"] != "", p["description"]).otherwise("Unknown polymer")))
    kinds = F.filter(kinds, lambda d: F.exists(polymers, lambda p: (F.when(p["description"] != "", p["description"]).otherwise("Unknown polymer") == d) & (F.size(p["listed"]) > 0)))

    def line(d):
        own = F.flatten(F.transform(F.filter(polymers, lambda p: F.when(p["description"] != "", p["description"]).otherwise("Unknown polymer") == d), lambda p: p["listed"]))
        return F.concat(F.lit("- Chain(s) "), F.array_join(F.array_sort(own), ", "), F.lit(": "), d)

    n = F.size(F.array_distinct(F.flatten(F.transform(polymers, lambda p: p["listed"])))).cast("string")
    none = F.concat(F.lit("### CHAIN INVENTORY REMINDER\nThis structure ("), entity, F.lit(") contains 0 polymer chains."))
    head = F.concat(F.lit("### CHAIN INVENTORY REMINDER\nThis structure ("), entity, F.lit(") contains EXACTLY "), n, F.lit(" unique polymer chain(s):"))
    return F.when(F.size(polymers) == 0, none).otherwise(F.array_join(F.concat(F.array(head), F.transform(kinds, line)), "\n"))


def simplified(rows: DataFrame) -> DataFrame:
    """rows (entries' columns) with ``simple``: what a request says of an entry, without buffers and ions. What is absent is Unknown, or null."""
    polymers = F.transform("polymers", lambda p: F.struct(p["listed"].alias("chain_ids"), F.when(p["description"] != "", p["description"]).otherwise("Unknown").alias("description"), F.transform(p["names"], lambda u: u["accession"]).alias("uniprot_accessions"), p["slugs"].alias("entry_names")))
    others = F.transform(F.filter("components", lambda c: ~c["code"].isin(*BUFFERS)), lambda c: F.struct(c["code"].alias("chem_comp_id"), F.when(c["name"] != "", c["name"]).otherwise(c["code"]).alias("name"), c["cid"].alias("pubchem_cid")))
    details = F.struct(F.col("entity").alias("pdb_id"), F.coalesce("method", F.lit("Unknown")).alias("method"), "resolution", "release_date")
    return rows.withColumn("simple", F.struct(details.alias("structure_details"), polymers.alias("polymer_components"), others.alias("non_polymer_components")))


def prompts(rows: DataFrame, template: str) -> DataFrame:
    """entity, prompt from rows (entries' columns and siblings): template, inventory, a warning about siblings, metadata. Fixed wording."""
    some = F.coalesce(F.size("siblings") > 0, F.lit(False))
    warning = F.concat(
        F.lit("### IMPORTANT: SIBLING STRUCTURES WARNING\nThis paper also reports structures for the following PDB IDs: "), F.array_join("siblings", ", "), F.lit(".\nEnsure you are extracting data ONLY for "), F.col("entity"),
        F.lit(". Do NOT mix up ligands or active states with the sibling structures reported in the same paper.\n\n"),
    )
    parts = [F.lit(template + "\n\n"), inventory(F.col("entity"), F.col("polymers")), F.lit("\n\n"), F.when(some, warning).otherwise(""), F.lit("--- PDB METADATA FOR "), F.col("entity"), F.lit(" ---\n"), F.to_json("simple"), F.lit("\n\n--- FULL PAPER ---\n")]
    return simplified(rows).select("entity", F.concat(*parts).alias("prompt"))
