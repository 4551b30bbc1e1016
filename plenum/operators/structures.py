"""Checks of annotated structures against the metadata of their entry.

A record meets its entry in one equi-join by entity. All that follows is expressions over the two, as a record's
chains, components and ligands are few and belong together: no further shuffle, and keys need not be unique. Only
the walk over all nodes, and sequences of references, are tables of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plenum.functions.text import BLANKS, NULL_LIKE, hamming, has_prefix
from plenum.plans.tables import cut

#: What a record says where nothing is bound, kinds that are found by chain, and component codes of
#: buffers, ions and the like.
NOTHING_BOUND = "apo"
BY_CHAIN = ("peptide", "protein")
BUFFERS = (
    "HOH", "WAT", "DOD", "SO4", "PO4", "GOL", "EDO", "PEG", "PGE", "PG4", "BME", "TRS", "MES", "HEPES", "CIT", "ACE", "FMT", "DMSO",
    "NA", "K", "CL", "MG", "ZN", "MN", "FE", "HG", "CD", "NAD", "NADP", "FAD", "COA", "NAG", "MAN", "GAL", "FUC", "PLM",
)

#: Beginnings of entry names that are no receptors.
NO_RECEPTORS = (
    "gnai", "gnas", "gnaq", "gna1", "gnao", "gnaz", "gnal", "gnat", "gbb", "gbg", "arr", "grk", "ramp", "glha", "fshb", "lhb", "tshb", "cgb",
    "enlys", "c562", "fkb", "mamb", "gloc", "iapp", "gluc", "gon", "rel", "racd", "npmb", "rarr2", "a0a", "mtor",
)

#: Accessions and names of the alpha subunits that tails are compared with, those that ties go to, and
#: words of other proteins.
ALPHAS = {
    "P63092": "gnas2_human", "P38405": "gnal_human", "P63096": "gnai1_human", "P04899": "gnai2_human", "P08754": "gnai3_human",
    "P09471": "gnao_human", "P19086": "gnaz_human", "P11488": "gnat1_human", "P19087": "gnat2_human", "A8MTJ3": "gnat3_human",
    "P50148": "gnaq_human", "P29992": "gna11_human", "O95837": "gna14_human", "P30679": "gna15_human", "Q03113": "gna12_human", "Q14344": "gna13_human",
}
LEADERS = ("gnas2_human", "gnai1_human", "gnaq_human", "gna13_human")
NO_ALPHAS = ("receptor", "antibody", "nanobody", "fab", "scfv", "ubiquitin", "beta", "gamma", "gbg", "gbb", "subunit b", "subunit c", "subunit g")
TAIL, ENOUGH, SEGMENTS = 4, 0.5, 6

#: Kinds of features that are membrane segments, of an entity and of an accession, what makes a domain
#: one, kinds that count for the choice among fused proteins, and kinds of residues that aren't seen.
MEMBRANE = ("TRANSMEMBRANE", "MEMBRANE_REGION", "MEMBRANE_TOPOLOGY", "MEMBRANE_SEGMENT", "MEMBRANE_DOMAIN", "MEMBRANE")
MEMBRANE_OF_NAME = ("TRANSMEMBRANE", "MEMBRANE", "TOPOLOGICAL_DOMAIN", "TRANSMEMBRANE_REGION", "MEMBRANE_SEGMENT", "MEMBRANE_DOMAIN")
DOMAIN, FUSED, UNSEEN = "TOPOLOGICAL_DOMAIN", ("TRANSMEMBRANE", "TRANSMEMBRANE_REGION"), ("UNOBSERVED_RESIDUE_XYZ", "UNMODELED")
PARTNERS = ("gnai", "gnas", "gnaq", "gnao")

_PLACES = "feature_positions:array<struct<beg_seq_id:long,end_seq_id:long>>"
_FEATURES = f"""struct<data:struct<entry:struct<polymer_entities:array<struct<
    rcsb_polymer_entity_feature:array<struct<type:string,{_PLACES}>>,
    rcsb_polymer_entity_align:array<struct<reference_database_name:string,reference_database_accession:string,
        aligned_regions:array<struct<ref_beg_seq_id:long,entity_beg_seq_id:long,length:long>>>>,
    uniprots:array<struct<rcsb_id:string,rcsb_uniprot_feature:array<struct<type:string,description:string,{_PLACES}>>>>,
    polymer_entity_instances:array<struct<rcsb_polymer_entity_instance_container_identifiers:struct<auth_asym_id:string>,
        rcsb_polymer_instance_feature:array<struct<type:string,{_PLACES}>>>>>>>>>"""


def _schema(mark: str) -> str:
    poly = f"""array<struct<rcsb_polymer_entity:struct<pdbx_description:string>,
        rcsb_polymer_entity_container_identifiers:struct<auth_asym_ids:array<string>>,
        entity_poly:struct<type:string,pdbx_seq_one_letter_code_can:string,pdbx_seq_one_letter_code:string,rcsb_sample_sequence_length:int>,
        uniprots:array<struct<rcsb_id:string,{mark}_entry_name_slug:string>>,
        polymer_entity_instances:array<struct<rcsb_polymer_entity_instance_container_identifiers:struct<auth_asym_id:string,asym_id:string>>>>>"""
    comp = f"""array<struct<nonpolymer_comp:struct<chem_comp:struct<id:string,name:string>,
        rcsb_chem_comp_descriptor:struct<InChIKey:string,SMILES:string,SMILES_stereo:string>,{mark}_pubchem_cid:string>,
        nonpolymer_entity_instances:array<struct<rcsb_nonpolymer_entity_instance_container_identifiers:struct<auth_asym_id:string>>>>>"""
    return f"""struct<data:struct<entry:struct<exptl:array<struct<method:string>>,em_3d_reconstruction:array<struct<resolution:double>>,
        refine:array<struct<ls_d_res_high:double>>,rcsb_accession_info:struct<initial_release_date:string>,
        assemblies:array<struct<rcsb_struct_symmetry:array<struct<oligomeric_state:string,stoichiometry:array<string>,kind:string,type:string>>>>,
        polymer_entities:{poly},nonpolymer_entities:{comp}>>>"""


def _some(c: Column) -> Column:
    """An array without its nulls; empty where it's null."""
    return F.coalesce(F.filter(c, lambda x: x.isNotNull()), F.array())


def _trim(c: Column) -> Column:
    return F.coalesce(F.trim(c, F.lit(BLANKS)), F.lit(""))


def _names_nothing(c: Column) -> Column:
    return F.lower(c).isin(*NULL_LIKE)


def _chains(c: Column) -> Column:
    """The distinct chains of a comma list, in order."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), _trim), lambda x: x != ""))


def _last(items: Column, field: str, key: Column) -> Column:
    """The last of some structs whose field is key, or null."""
    return F.try_element_at(F.filter(items, lambda x: x[field] == key), F.lit(-1))


def _listed(items: Column) -> Column:
    """An array as text: ['a', 'b']."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def entries(docs: DataFrame, mark: str) -> DataFrame:
    """entity, method, resolution, release_date, polymers, chains, labels, symmetry, components, chain_ids and codes of entry documents.

    labels: chains with another name of their own; of a chain that comes twice the last. symmetry: the first record there is.

    docs: entity, v (VARIANT). mark is what names of fields that an earlier step added begin with. What is null,
    absent or of another type at any depth counts as absent. Chains and components that come twice stand twice;
    lookups take the last.
    """
    e = F.from_json(F.to_json("v"), _schema(mark))["data"]["entry"]
    out = docs.select("entity", e.alias("e")).where("e IS NOT NULL")
    raw_date = F.substring_index(F.col("e.rcsb_accession_info.initial_release_date"), "T", 1)
    slug, cid = f"{mark}_entry_name_slug", f"{mark}_pubchem_cid"

    def polymer(p):
        names = _some(p["uniprots"])
        sequence = p["entity_poly"]["pdbx_seq_one_letter_code_can"]
        return F.struct(
            F.coalesce(p["rcsb_polymer_entity"]["pdbx_description"], F.lit("")).alias("description"),
            F.coalesce(sequence, F.lit("")).alias("sequence"),
            F.when(F.length(sequence) > 0, sequence).otherwise(p["entity_poly"]["pdbx_seq_one_letter_code"]).alias("any_sequence"),
            F.coalesce(p["entity_poly"]["rcsb_sample_sequence_length"], F.length(sequence), F.lit(0)).alias("length"),
            _some(p["rcsb_polymer_entity_container_identifiers"]["auth_asym_ids"]).alias("listed"),
            F.filter(F.transform(names, lambda u: u[slug]), lambda s: s != "").alias("slugs"),
            F.filter(F.transform(names, lambda u: F.struct(u["rcsb_id"].alias("accession"), u[slug].alias("slug"))), lambda u: (u["accession"] != "") & (u["slug"] != "")).alias("names"),
            F.filter(
                F.transform(_some(p["polymer_entity_instances"]["rcsb_polymer_entity_instance_container_identifiers"]), lambda i: F.struct(i["auth_asym_id"].alias("chain"), F.coalesce(F.when(i["asym_id"] != "", i["asym_id"]), i["auth_asym_id"]).alias("label"), (i["asym_id"] != "").alias("own"))),
                lambda i: i["chain"] != "",
            ).alias("instances"),
        )

    def component(n):
        c = n["nonpolymer_comp"]
        d = c["rcsb_chem_comp_descriptor"]
        return F.struct(c["chem_comp"]["id"].alias("code"), c["chem_comp"]["name"].alias("name"), d["InChIKey"].alias("InChIKey"), d["SMILES"].alias("SMILES"), d["SMILES_stereo"].alias("SMILES_stereo"), c[cid].alias("cid"))

    out = out.select(
        "entity",
        F.when(F.get("e.exptl", F.lit(0))["method"] != "", F.get("e.exptl", F.lit(0))["method"]).alias("method"),
        F.coalesce(F.get("e.em_3d_reconstruction", F.lit(0))["resolution"], F.get("e.refine", F.lit(0))["ls_d_res_high"]).alias("resolution"),
        F.when(raw_date != "", F.coalesce(F.date_format(F.try_to_date(raw_date, "yyyy-MM-dd"), "yyyy-MM-dd"), F.substring(raw_date, 1, 10))).alias("release_date"),
        F.get(F.flatten(F.transform(_some(F.col("e.assemblies")), lambda a: _some(a["rcsb_struct_symmetry"]))), F.lit(0)).alias("symmetry"),
        F.transform(_some(F.col("e.polymer_entities")), polymer).alias("polymers"),
        F.filter(F.transform(_some(F.col("e.nonpolymer_entities")), component), lambda c: c["code"] != "").alias("components"),
        F.filter(F.flatten(F.transform(_some(F.col("e.nonpolymer_entities")), lambda n: _some(n["nonpolymer_entity_instances"]["rcsb_nonpolymer_entity_instance_container_identifiers"]["auth_asym_id"]))), lambda c: c != "").alias("other_chains"),
    )
    chains = F.flatten(F.transform("polymers", lambda p: F.transform(p["instances"], lambda i: F.struct(i["chain"].alias("chain"), i["label"].alias("label"), p["description"].alias("description"), p["sequence"].alias("sequence")))))
    named = F.filter(F.flatten(F.transform("polymers", lambda p: p["instances"])), lambda i: i["own"])
    labels = F.transform(F.array_distinct(F.transform(named, lambda i: i["chain"])), lambda c: F.struct(c.alias("key"), _last(named, "chain", c)["label"].alias("value")))
    out = out.withColumns({"chains": chains, "labels": F.map_from_entries(labels)})
    return out.withColumns({"chain_ids": F.array_distinct(F.concat(F.transform("chains", lambda c: c["chain"]), "other_chains")), "codes": F.array_sort(F.array_distinct(F.transform("components", lambda c: c["code"])))}).drop("other_chains")


def ligand_checks(ligands: Column, chains: Column, components: Column) -> Column:
    """Per ligand (name, type, chain_id, chem_comp_id): status, sequence, identifiers and a message for ghosts.

    The first rule that holds: nothing bound; a peptide or protein on a known chain; a component of the entry that
    is no buffer; a buffer; else a ghost. Null ligands and null lists give null and empty results.
    """

    def one(g):
        code, chain, name, kind = (_trim(g[f]) for f in ("chem_comp_id", "chain_id", "name", "type"))
        hits = F.filter(F.transform(F.transform(F.split(chain, ","), _trim), lambda c: _last(chains, "chain", c)), lambda x: x.isNotNull())
        buffer = code.isin(*BUFFERS)
        part = F.when(~_names_nothing(code) & ~buffer, _last(components, "code", code))
        bound = F.lower(kind).isin(*BY_CHAIN) & ~_names_nothing(chain) & (F.size(hits) > 0)
        status = F.when((F.lower(name) == NOTHING_BOUND) | (F.lower(code) == NOTHING_BOUND), "SKIPPED_APO").when(bound, "MATCHED_POLYMER").when(part.isNotNull(), "MATCHED_SMALL_MOLECULE").when(buffer, "EXCLUDED_BUFFER").otherwise("GHOST_LIGAND")
        label = F.when(~_names_nothing(code), code).otherwise(name)
        ghost = F.concat(F.lit("GHOST_LIGAND at 'ligands["), label, F.lit("]': '"), name, F.lit("' ("), F.when(code != "", code).otherwise("no comp_id"), F.lit(") not found in API entities."))
        found = F.when(status == "MATCHED_SMALL_MOLECULE", part)
        return F.when(
            g.isNotNull(),
            F.struct(
                status.alias("status"),
                F.when(status == "MATCHED_POLYMER", F.array_join(F.filter(F.transform(hits, lambda x: x["sequence"]), lambda s: s != ""), " / ")).alias("sequence"),
                *[found[f].alias(f) for f in ("InChIKey", "SMILES", "SMILES_stereo", "cid")],
                F.when(status == "GHOST_LIGAND", ghost).alias("message"),
            ),
        )

    return F.transform(F.coalesce(ligands, F.array()), one)


def receptor_check(name: Column, chain: Column, polymers: Column) -> Column:
    """status, reality (all entry names of the chains reported) and a message for clashes.

    Of each chain the first polymer that lists it counts. All fields are null, and reality is empty, where name or
    chain is, or no chain is known.
    """
    met = F.transform(_chains(chain), lambda c: F.struct(c.alias("chain"), F.get(F.filter(polymers, lambda p: F.array_contains(p["listed"], c)), F.lit(0)).alias("of")))
    met = F.filter(met, lambda m: m["of"].isNotNull())
    clashes = F.filter(met, lambda m: ~F.array_contains(m["of"]["slugs"], name))
    told = (name != "") & (F.size(met) > 0)
    detail = F.array_join(F.transform(clashes, lambda m: F.concat(F.lit("Chain "), m["chain"], F.lit(" -> "), _listed(m["of"]["slugs"]))), ", ")
    return F.struct(
        F.when(told, F.when(F.size(clashes) == 0, "RECEPTOR_MATCH").otherwise("UNIPROT_CLASH")).alias("status"),
        F.when(told, F.array_distinct(F.flatten(F.transform(met, lambda m: m["of"]["slugs"])))).otherwise(F.array()).alias("reality"),
        F.when(told & (F.size(clashes) > 0), F.concat(F.lit("UNIPROT_CLASH at 'receptor_info': '"), name, F.lit("' clashes on "), detail, F.lit("."))).alias("message"),
    )


def roster(polymers: Column) -> Column:
    """chain, slug, length, label of the receptor chains; of a chain that comes twice the last polymer counts."""

    def of(p):
        slug = F.get(F.filter(p["slugs"], lambda s: ~has_prefix(s, NO_RECEPTORS)), F.lit(0))
        return F.when(slug.isNotNull(), F.transform(p["instances"], lambda i: F.struct(i["chain"].alias("chain"), slug.alias("slug"), p["length"].alias("length"), i["label"].alias("label")))).otherwise(F.array())

    every = F.flatten(F.transform(polymers, of))
    return F.transform(F.array_distinct(F.transform(every, lambda r: r["chain"])), lambda c: _last(every, "chain", c))


def classification(members: Column) -> Column:
    """What a roster is: no receptor, one, several alike, or several that differ."""
    kinds = F.size(F.array_distinct(F.transform(members, lambda r: r["slug"])))
    return F.when(F.size(members) == 0, "NO_GPCR").when(F.size(members) == 1, "MONOMER").when(kinds == 1, "HOMOMER").otherwise("HETEROMER")


def roster_alerts(chain: Column, members: Column) -> Column:
    """type and chains: reported chains that aren't in the roster, and roster chains missed or all confirmed."""
    own, known = _chains(chain), F.transform(members, lambda r: r["chain"])
    alien, missed, hits = F.array_except(own, known), F.array_except(known, own), F.array_intersect(own, known)

    def alert(kind, chains, when):
        return F.when(when & (F.size(own) > 0) & (F.size(known) > 0), F.struct(F.lit(kind).alias("type"), F.array_sort(chains).alias("chains")))

    several = (F.size(known) > 1) & (F.size(hits) > 0)
    return F.array_compact(F.array(alert("HALLUCINATION", alien, F.size(alien) > 0), alert("MISSED_PROTOMER", missed, several & (F.size(missed) > 0)), alert("CONFIRMED_OLIGOMER", own, several & (F.size(missed) == 0))))


def primary(members: Column, chain: Column, partner: Column, ligand_chains: Column) -> Column:
    """chain and rank of the member that stands for all; members also have resolved, their segments seen.

    1: the chain reported, where a partner is bound. 2: the only member with a ligand. 3: strictly most segments.
    4: the first chain reported that is a member, else the longest, of equal ones the first. Members that are all
    alike have rank 0, whichever rule chose. An empty roster gives nulls.
    """
    known = F.transform(members, lambda r: r["chain"])
    bound = F.array_intersect(known, F.filter(F.coalesce(ligand_chains, F.array()), lambda c: ~_names_nothing(c)))
    most = F.array_max(F.transform(members, lambda r: r["resolved"]))
    top = F.filter(members, lambda r: r["resolved"] == most)
    longest = F.array_max(F.transform(members, lambda r: r["length"]))
    first = F.when(F.coalesce(partner, F.lit(False)) & F.array_contains(known, chain), chain)
    second = F.when(F.size(bound) == 1, F.get(bound, F.lit(0)))
    third = F.when((most > 0) & (F.size(top) == 1), F.get(top, F.lit(0))["chain"])
    fourth = F.coalesce(F.get(F.array_intersect(_chains(chain), known), F.lit(0)), F.get(F.filter(members, lambda r: r["length"] == longest), F.lit(0))["chain"])
    rank = F.when(first.isNotNull(), 1).when(second.isNotNull(), 2).when(third.isNotNull(), 3).when(fourth.isNotNull(), 4)
    return F.struct(F.coalesce(first, second, third, fourth).alias("chain"), F.when(rank.isNotNull() & (classification(members) == "HOMOMER"), 0).otherwise(rank).alias("rank"))


def aligned(segment: Column, regions: Column) -> Column:
    """The parts (b, e) of a segment in an entity's numbering; regions: ref_beg_seq_id, entity_beg_seq_id, length."""

    def part(r):
        shift = r["entity_beg_seq_id"] - r["ref_beg_seq_id"]
        return F.struct((F.greatest(segment["b"], r["ref_beg_seq_id"]) + shift).alias("b"), (F.least(segment["e"], r["ref_beg_seq_id"] + r["length"] - 1) + shift).alias("e"))

    return F.filter(F.transform(regions, part), lambda p: p["b"] <= p["e"])


def features(docs: DataFrame) -> DataFrame:
    """entity, chain, segments, gaps (b, e) and proteins (name, n) of captured feature documents (entity, v VARIANT).

    Segments are the entity's own membrane features; where it has none, those of its accessions, put into its
    numbering by their alignments. gaps are residues of the chain that aren't seen. n counts an accession's segments.
    A chain that comes twice stands twice; null or absent parts count as none.
    """

    def places(items, kinds, keep=None):
        some = F.filter(_some(items), lambda f: F.upper(f["type"]).isin(*kinds) & (keep(f) if keep else F.lit(True)))
        return F.flatten(F.transform(some, lambda f: F.transform(_some(f["feature_positions"]), lambda p: F.struct(p["beg_seq_id"].alias("b"), p["end_seq_id"].alias("e")))))

    def is_segment(f):
        return (F.upper(f["type"]) != DOMAIN) | F.coalesce(F.upper(f["description"]).contains("MEMBRANE"), F.lit(False))

    p = F.col("p")
    aligns = F.filter(_some(p["rcsb_polymer_entity_align"]), lambda a: a["reference_database_name"] == "UniProt")

    def mapped(u):
        regions = F.flatten(F.transform(F.filter(aligns, lambda a: F.coalesce(a["reference_database_accession"], F.lit("")) == F.coalesce(u["rcsb_id"], F.lit(""))), lambda a: _some(a["aligned_regions"])))
        return F.flatten(F.transform(places(u["rcsb_uniprot_feature"], MEMBRANE_OF_NAME, is_segment), lambda s: aligned(s, regions)))

    own = places(p["rcsb_polymer_entity_feature"], MEMBRANE)
    names = _some(p["uniprots"])
    proteins = F.transform(names, lambda u: F.struct(u["rcsb_id"].alias("name"), F.size(places(u["rcsb_uniprot_feature"], FUSED)).cast("long").alias("n")))
    rows = docs.select("entity", F.explode(F.from_json(F.to_json("v"), _FEATURES)["data"]["entry"]["polymer_entities"]).alias("p")).where("p IS NOT NULL")
    rows = rows.select("entity", "p", F.when(F.size(own) > 0, own).otherwise(F.flatten(F.transform(names, mapped))).alias("segments"), proteins.alias("proteins"))
    rows = rows.select("entity", "segments", "proteins", F.explode(_some(F.col("p.polymer_entity_instances"))).alias("i"))
    gaps = F.flatten(F.transform(F.filter(_some(F.col("i.rcsb_polymer_instance_feature")), lambda f: f["type"].isin(*UNSEEN)), lambda f: F.transform(_some(f["feature_positions"]), lambda g: F.struct(g["beg_seq_id"].alias("b"), g["end_seq_id"].alias("e")))))
    rows = rows.select("entity", F.col("i.rcsb_polymer_entity_instance_container_identifiers.auth_asym_id").alias("chain"), "segments", gaps.alias("gaps"), "proteins")
    return rows.where("chain <> ''")


def suspicious(members: Column) -> Column:
    """The alert about members without any segment, or null; members: chain, slug, status."""
    odd = F.filter(members, lambda m: m["status"] == "UNKNOWN")
    names = F.array_join(F.transform(odd, lambda m: F.concat(F.lit("Chain "), m["chain"], F.lit(" ("), m["slug"], F.lit(")"))), ", ")
    return F.when(F.size(odd) > 0, F.struct(F.lit("SUSPICIOUS_7TM").alias("type"), F.concat(F.lit("[SUSPICIOUS_7TM] at 'oligomer_analysis': "), names, F.lit(": NO transmembrane helices detected.")).alias("message")))


def _told(alert: Column, own: Column, known: Column) -> Column:
    """The message of a roster alert."""
    kind, chains = alert["type"], _listed(alert["chains"])
    roster_, hits = _listed(F.array_sort(known)), _listed(F.array_sort(F.array_intersect(own, known)))
    text = (
        F.when(kind == "HALLUCINATION", F.concat(F.lit("AI selected chain(s) "), chains, F.lit(" which are NOT in the GPCR roster (roster: "), roster_, F.lit("). The AI may have picked a G-protein, nanobody, or other non-GPCR chain.")))
        .when(kind == "MISSED_PROTOMER", F.concat(F.lit("GPCR roster has chains "), roster_, F.lit(" but AI only reported "), hits, F.lit(". Missed: "), chains, F.lit(".")))
        .otherwise(F.concat(F.lit("AI reported chain(s) "), chains, F.lit(" — matches GPCR roster "), roster_, F.lit(".")))
    )
    return F.struct(kind.alias("type"), F.concat(F.lit("["), kind, F.lit("] at 'oligomer_analysis': "), text).alias("message"))


def oligomer(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """rows (entity, v and entries' columns) with ``oligo``: classification, members, suggestion, alerts, override, labels and symmetry.

    found: features. The roster is refined by the proteins of fused chains, each member's segments are judged, and
    the rest follows from that. A chain that stands twice in found has the last in order of its segments. Without
    found, or for chains that it lacks, nothing is known of segments.
    """
    kind = "array<struct<chain:string,segments:array<struct<b:bigint,e:bigint>>,gaps:array<struct<b:bigint,e:bigint>>,proteins:array<struct<name:string,n:bigint>>>>"
    if found is None:
        rows = rows.withColumn("seen", F.array().cast(kind))
    else:
        per = found.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("chain", "segments", "gaps", "proteins"))).cast(kind).alias("seen"))
        rows = rows.join(per, "entity", "left").withColumn("seen", F.coalesce("seen", F.array().cast(kind)))
    said = F.from_json(F.to_json("v"), "struct<receptor_info:struct<uniprot_entry_name:string,chain_id:string>,ligands:array<struct<chain_id:string>>>")
    every = F.flatten(F.transform("polymers", lambda p: p["names"]))
    slugs = F.map_from_entries(F.transform(F.array_distinct(F.transform(every, lambda u: u["accession"])), lambda a: F.struct(a.alias("key"), _last(every, "accession", a)["slug"].alias("value"))))
    chains = F.array_distinct(F.transform("seen", lambda s: s["chain"]))
    proteins = F.map_from_entries(F.transform(chains, lambda c: F.struct(c.alias("key"), _last(F.col("seen"), "chain", c)["proteins"].alias("value"))))
    rows = cut(rows.withColumns({"said": said, "roster": roster(F.col("polymers")), "slugs_": slugs, "proteins_": proteins}))
    rows = cut(rows.withColumn("roster", refined(F.col("roster"), F.col("proteins_"), F.col("slugs_"))))

    def judged(m):
        s = _last(F.col("seen"), "chain", m["chain"])
        done = completeness(s["segments"], s["gaps"])
        return F.struct(m["chain"].alias("chain"), m["slug"].alias("slug"), m["length"].alias("length"), done["status"].alias("status"), done["resolved"].alias("resolved"), done["total"].alias("total"))

    rows = cut(rows.withColumn("roster", F.transform("roster", judged)))
    partners = F.try_variant_get("v", "$.signaling_partners", "map<string,variant>")
    named = F.lower(F.to_json(F.try_variant_get("v", "$.signaling_partners", "variant")))
    bound = F.coalesce(F.map_contains_key(partners, "g_protein") | F.exists(F.array(*map(F.lit, PARTNERS)), lambda t: F.contains(named, t)), F.lit(False))
    chain = F.col("said.receptor_info.chain_id")
    rows = rows.withColumn("pick", primary(F.col("roster"), chain, bound, F.transform("said.ligands", lambda g: g["chain_id"])))
    rows = cut(rows.withColumns({"kind_": classification(F.col("roster")), "alerts_": roster_alerts(chain, F.col("roster"))}))
    rows = cut(rows.withColumn("over", override(chain, F.col("said.receptor_info.uniprot_entry_name"), F.col("pick.chain"), F.col("roster"), F.col("alerts_"))))
    own, known = _chains(chain), F.transform("roster", lambda r: r["chain"])
    told = F.transform("alerts_", lambda a: _told(a, own, known))
    over, pick = F.col("over"), F.col("pick")
    note = F.concat(F.lit("[CHAIN_ID_OVERRIDDEN] at 'oligomer_analysis': receptor_info corrected: chain_id '"), over["original_chain_id"], F.lit("' -> '"), over["corrected_chain_id"], F.lit("', uniprot_entry_name '"), F.coalesce(over["original_uniprot"], F.lit("None")), F.lit("' -> '"), F.coalesce(over["corrected_uniprot"], F.lit("None")), F.lit("'. Reason: "), over["trigger"])
    corrected = F.when(over["applied"], F.struct(F.lit("CHAIN_ID_OVERRIDDEN").alias("type"), note.alias("message")))
    members = F.array_sort(F.transform("roster", lambda m: F.struct(m["chain"].alias("chain_id"), m["slug"].alias("slug"), m["status"].alias("7tm_status"), m["resolved"].alias("resolved_tms"), m["total"].alias("total_tms"))))
    reason = F.when(pick["rank"].isNull(), "No GPCR chains found").otherwise(F.concat(F.lit("Rank "), pick["rank"].cast("string")))
    oligo = F.struct(
        F.col("kind_").alias("classification"),
        members.alias("all_gpcr_chains"),
        F.struct(pick["chain"].alias("chain_id"), reason.alias("reason"), pick["rank"].alias("rank_used")).alias("primary_protomer_suggestion"),
        F.col("symmetry").alias("assembly_cross_check"),
        F.array_compact(F.concat(told, F.array(suspicious(F.col("roster"))), F.array(corrected))).alias("alerts"),
        over.alias("chain_id_override"),
        F.col("labels").alias("label_asym_id_map"),
    )
    return cut(rows.withColumn("oligo", oligo)).drop("said", "roster", "slugs_", "proteins_", "pick", "kind_", "alerts_", "over", "seen")


def with_oligomer(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """rows whose v has oligomer_analysis, and the chain and name of the receptor as the override leaves them. v must be an object."""
    from plenum.functions.records import patched, written

    rows, over = oligomer(rows, found), F.col("oligo.chain_id_override")
    v = written(F.col("v"), {"oligomer_analysis": F.to_variant_object("oligo")})
    made = {"chain_id": F.when(over["applied"], over["corrected_chain_id"].cast("variant")), "uniprot_entry_name": F.when(over["applied"], over["corrected_uniprot"].cast("variant"))}
    return rows.withColumn("v", F.when(over["applied"], patched(v, "receptor_info", made)).otherwise(v)).drop("oligo")


def completeness(segments: Column, gaps: Column, least: float = ENOUGH, complete: int = SEGMENTS) -> Column:
    """resolved, total and status of segments (b, e) that gaps (b, e) leave seen by at least ``least``."""

    def add(held, g):
        last = F.try_element_at(held, F.lit(-1))
        joined = F.concat(F.slice(held, 1, F.size(held) - 1), F.array(F.struct(last["b"].alias("b"), F.greatest(last["e"], g["e"]).alias("e"))))
        return F.when((F.size(held) > 0) & (g["b"] <= last["e"]), joined).otherwise(F.concat(held, F.array(g)))

    kind = "array<struct<b:long,e:long>>"
    gaps, segments = F.coalesce(gaps.cast(kind), F.array().cast(kind)), F.coalesce(segments.cast(kind), F.array().cast(kind))
    merged = F.aggregate(F.array_sort(gaps), F.array().cast(kind), add)

    def seen(s):
        hidden = F.aggregate(F.transform(merged, lambda g: F.greatest(F.lit(0), F.least(s["e"], g["e"]) - F.greatest(s["b"], g["b"]) + 1)), F.lit(0).cast("long"), lambda a, x: a + x)
        length = s["e"] - s["b"] + 1
        return (length > 0) & ((length - hidden) / F.greatest(length, F.lit(1)) >= least)

    resolved = F.size(F.filter(segments, seen))
    return F.struct(resolved.alias("resolved"), F.size(segments).alias("total"), F.when(F.size(segments) == 0, "UNKNOWN").when(resolved >= complete, "COMPLETE").otherwise("INCOMPLETE_7TM").alias("status"))


def integrity(walked: DataFrame, context: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """entity, path, message of nodes that the entry contradicts.

    walked: tree.nodes by entity. context: entries. known: key (``uniprot:name`` in lower case up to a dot, or ``pubchem:digits``) and
    found (true, false; null or no row: can't be told); an id without digits is false. Without known, names and ids aren't looked up. An empty set of
    chains or codes accuses nothing.
    """
    path = F.expr("left(path, greatest(0, length(path) - length(name) - 1))")
    rows = walked.where(F.col("name").isin("chain_id", "uniprot_entry_name", "pubchem_id", "chem_comp_id", "method"))
    rows = rows.select("entity", "name", "kind", F.col("path").alias("full"), F.when(path == "", "").otherwise(F.concat(F.lit("."), path)).alias("path"), F.try_variant_get(F.try_parse_json("value"), "$", "string").alias("val"), F.col("value").startswith('"').alias("is_text"))
    rows = rows.join(context.select("entity", "chain_ids", "codes", F.lower("method").alias("real")), "entity")
    stated = F.coalesce(~_names_nothing(F.col("val")), F.lit(False))
    here = F.concat(F.lit(" at '"), F.col("path"), F.lit("': "))
    quoted = F.concat(F.lit("'"), F.col("val"), F.lit("'"))
    ghosts = F.filter(F.transform(F.split(F.regexp_replace("val", ";", ","), ","), _trim), lambda c: (c != "") & ~F.array_contains("chain_ids", c))
    ghosts = F.when((F.col("name") == "chain_id") & stated & (F.lower("val") != NOTHING_BOUND) & (F.size("chain_ids") > 0), F.transform(ghosts, lambda c: F.concat(F.lit("Ghost Chain"), here, F.lit("'"), c, F.lit("' not in PDB Source."))))
    odd = (F.col("name") == "uniprot_entry_name") & stated & F.col("is_text") & ~F.col("val").contains("_")
    ghost_code = (F.col("name") == "chem_comp_id") & stated & (F.lower("val") != NOTHING_BOUND) & (F.size("codes") > 0) & ~F.array_contains("codes", F.col("val"))
    said = F.lower(F.coalesce("val", F.lit("none")))
    conflict = (F.col("full") == "structure_info.method") & ((F.col("real").contains("x-ray") & ~said.contains("x-ray")) | (F.col("real").contains("electron") & ~said.contains("electron") & ~said.contains("cryo")))
    single = F.array_compact(
        F.array(
            F.when(odd, F.concat(F.lit("Invalid Format"), here, quoted, F.lit(" (Expected: name_species)"))),
            F.when(ghost_code, F.concat(F.lit("Ghost Ligand ID"), here, quoted, F.lit(" not found in PDB Metadata (valid: "), _listed(F.col("codes")), F.lit(")."))),
            F.when(conflict, F.concat(F.lit("Method Conflict at 'structure_info': PDB says '"), F.col("real"), F.lit("', AI says '"), said, F.lit("'."))),
        )
    )
    out = rows.select("entity", "path", F.explode(F.concat(F.coalesce(ghosts, F.array()), single)).alias("message"))
    if known is None:
        return out
    asks = F.when((F.col("name") == "uniprot_entry_name") & F.col("is_text") & F.col("val").contains("_"), "uniprot").when(F.col("name") == "pubchem_id", "pubchem")
    asked = rows.where(stated & asks.isNotNull()).withColumn("source", asks)
    digits = F.regexp_replace("val", "[^0-9]", "")
    asked = asked.withColumns({"key": F.concat_ws(":", "source", F.when(asks == "pubchem", digits).otherwise(F.lower(F.substring_index("val", ".", 1)))), "no_id": (F.col("source") == "pubchem") & (digits == "")})
    met = asked.join(known.select("key", "found"), "key", "left").withColumn("found", F.when(F.col("no_id"), False).otherwise(F.col("found"))).where("found IS NULL OR NOT found")
    name = F.col("source") == "uniprot"
    false = F.when(name, F.concat(F.lit("Fake UniProt ID"), here, quoted, F.lit(" does not exist in UniProtKB."))).otherwise(F.concat(F.lit("Invalid PubChem CID"), here, quoted, F.lit(" does not exist in PubChem.")))
    unknown = F.concat(F.lit("[API_UNAVAILABLE]"), here, F.lit("Could not verify "), F.when(name, "UniProt ID ").otherwise("PubChem CID "), quoted, F.lit("."))
    return out.unionByName(met.select("entity", "path", F.when(F.col("found").isNull(), unknown).otherwise(false).alias("message")))


def is_alpha(description: Column) -> Column:
    """Whether a description is that of a G-alpha subunit. Its words and patterns are fixed values."""
    d = F.lower(F.coalesce(description, F.lit("")))

    def holds(*words):
        return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(d, w))

    other = holds(*NO_ALPHAS) & ~holds("alpha")
    family = holds("guanine", "g protein") & (d.rlike(r"\bg[sioq]\b") | d.rlike(r"\bg1[123]\b"))
    mini = F.contains(F.regexp_replace(d, "-", ""), F.lit("minig")) | holds("engineered g13")
    ends = F.trim(d).rlike(r"guanine nucleotide-binding protein g\([a-z]\)$")
    named = holds("g alpha", "g-alpha", "galpha", "g_alpha") | (holds("alpha") & holds("g protein", "guanine", "g-protein", "g subunit"))
    return ~other & (named | (holds("subunit a") & holds("g protein", "guanine")) | family | mini | ends | (holds("guanine nucleotide-binding protein") & holds("subunit alpha", "alpha subunit")))


def tails(context: DataFrame, references: DataFrame) -> DataFrame:
    """entity, status, best, score, tail and ties: whose last residues the first alpha subunit of an entry has.

    context: entries. references: accession, sequence. The fixed accessions are looked up once (at most 16 rows come
    to the driver), an entry's own by a join. An own accession renames a fixed one; of equal names the last score
    counts. Ties go to the leader with that very tail, else to what stands first.
    """
    at = references.where(F.length("sequence") >= TAIL).select("accession", F.right("sequence", F.lit(TAIL)).alias("tail"))
    fixed = {r["accession"]: r["tail"] for r in at.where(F.col("accession").isin(*ALPHAS)).groupBy("accession").agg(F.max("tail").alias("tail")).collect()}
    lead: dict[str, str] = {}
    for slug in LEADERS:
        for accession in (a for a, s in ALPHAS.items() if s == slug and a in fixed):
            lead.setdefault(fixed[accession], slug)
    kind = "array<struct<accession:string,slug:string,tail:string>>"
    always = F.array(*[F.struct(F.lit(a).alias("accession"), F.lit(s).alias("slug"), F.lit(fixed[a]).alias("tail")) for a, s in ALPHAS.items() if a in fixed]).cast(kind)
    rows = context.select("entity", F.get(F.filter("polymers", lambda p: is_alpha(p["description"])), F.lit(0)).alias("p"))
    own = rows.select("entity", F.posexplode("p.names").alias("pos", "n")).select("entity", "pos", "n.accession", "n.slug")
    own = own.join(at.where(~F.col("accession").isin(*ALPHAS)), "accession", "left").withColumn("tail", F.when(F.col("accession").isin(*ALPHAS), F.lit("")).otherwise(F.col("tail")))
    own = own.where("tail IS NOT NULL").groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("pos", "accession", "slug", "tail"))).alias("own"))
    rows = rows.join(own, "entity", "left").withColumn("own", F.coalesce("own", F.array()))
    renamed = F.transform(always, lambda c: F.struct(c["accession"].alias("accession"), F.coalesce(_last(F.col("own"), "accession", c["accession"])["slug"], c["slug"]).alias("slug"), c["tail"].alias("tail")))
    others = F.filter("own", lambda o: o["tail"] != "")
    added = F.transform(F.array_distinct(F.transform(others, lambda o: o["accession"])), lambda a: F.struct(a.alias("accession"), _last(others, "accession", a)["slug"].alias("slug"), _last(others, "accession", a)["tail"].alias("tail")))
    rows = rows.withColumn("all", F.concat(renamed.cast(kind), added.cast(kind))).withColumn("tail", F.when(F.length("p.any_sequence") >= TAIL, F.right("p.any_sequence", F.lit(TAIL))))
    scored = F.transform(F.array_distinct(F.transform("all", lambda c: c["slug"])), lambda s: F.struct(s.alias("slug"), hamming(F.col("tail"), _last(F.col("all"), "slug", s)["tail"]).alias("score")))
    rows = rows.withColumn("scores", scored).withColumn("score", F.array_max(F.transform("scores", lambda x: x["score"])))
    rows = rows.withColumn("ties", F.transform(F.filter("scores", lambda x: x["score"] == F.col("score")), lambda x: x["slug"]))
    leader = F.lit(None).cast("string")
    for tail, slug in lead.items():
        leader = F.when(F.col("tail") == tail, slug).otherwise(leader)
    status = F.when(F.col("p").isNull(), "no_g_protein_found").when(F.col("tail").isNull(), "sequence_too_short").when(F.size("all") == 0, "no_valid_comparisons").otherwise("success")
    good = F.col("status") == "success"
    return rows.withColumn("status", status).select("entity", "status", F.when(good, F.coalesce(leader, F.get("ties", F.lit(0)))).alias("best"), F.when(good, F.col("score")).otherwise(0).alias("score"), F.when(good, F.col("tail")).alias("tail"), F.when(good, F.col("ties")).otherwise(F.array()).alias("ties"))


def most(proteins: Column) -> Column:
    """The name of those (name, n) with the largest n, of equal ones the first; null for fewer than two or if all n are 0."""
    top = F.array_max(F.transform(proteins, lambda p: p["n"]))
    return F.when((F.size(proteins) > 1) & (top > 0), F.get(F.filter(proteins, lambda p: p["n"] == top), F.lit(0))["name"])


def refined(members: Column, proteins: Column, slugs: Column) -> Column:
    """A roster with the slug of the protein that has most segments, where a chain is a fusion of several.

    proteins: a map of chains to (name, n), names being accessions; slugs: a map of accessions to slugs. Slugs that
    are no receptors, chains without proteins and accessions without a slug leave a member as it is.
    """

    def of(m):
        slug = slugs[most(proteins[m["chain"]])]
        return m.withField("slug", F.when(slug.isNotNull() & ~has_prefix(slug, NO_RECEPTORS), slug).otherwise(m["slug"]))

    return F.transform(members, of)


def override(chain: Column, name: Column, suggested: Column, members: Column, alerts: Column) -> Column:
    """applied, trigger, and chain and name before and after: the suggested chain replaces one that is plainly wrong.

    That is a chain that an alert calls invented, or one whose segments are incomplete while the suggested one's are
    complete; members have chain, slug and status. Without a chain or a suggestion, or if they agree, nothing is applied.
    """
    own, other = _last(members, "chain", chain), _last(members, "chain", suggested)
    differ = F.coalesce((chain != "") & (suggested != "") & (chain != suggested), F.lit(False))
    invented = F.exists(F.coalesce(alerts, F.array().cast("array<struct<type:string,chains:array<string>>>")), lambda a: a["type"] == "HALLUCINATION")
    better = (own["status"] == "INCOMPLETE_7TM") & (other["status"] == "COMPLETE")
    trigger = F.when(differ & F.coalesce(invented, F.lit(False)), "HALLUCINATION").when(differ & better, "7TM_UPGRADE")
    applied = trigger.isNotNull()
    slug = F.when(other["slug"] != "", other["slug"])
    return F.struct(
        applied.alias("applied"),
        trigger.alias("trigger"),
        chain.alias("original_chain_id"),
        F.when(applied, suggested).otherwise(chain).alias("corrected_chain_id"),
        name.alias("original_uniprot"),
        F.when(applied, F.coalesce(slug, name)).otherwise(name).alias("corrected_uniprot"),
    )
