"""What may be accepted without a reviewer, what a reviewer's text becomes, and which paths are settled already.

A record's differing paths and messages are few, so they are arrays beside it: all is expressions, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reference import waterfall

#: Last names of paths on which runs may differ without a reviewer, and the block that conflicts concern.
TRIVIAL = ("source", "reasoning", "quote_or_path", "confidence", "synonyms")
PARTNERS = "signaling_partners"


def _some(items: Column) -> Column:
    return F.coalesce(F.filter(items, lambda x: x.isNotNull()), F.array().cast("array<string>"))


def last_name(path: Column) -> Column:
    """The name that a path ends with, without its index."""
    return F.regexp_extract(path, r"([^.\[]*)(?:\[[^.]*)?$", 1)


def below(paths: Column, block: Column) -> Column:
    """Those of some paths that are a block or lie in it; the empty block holds all."""
    return F.filter(_some(paths), lambda p: (block == "") | (p == block) | p.startswith(F.concat(block, F.lit("."))) | p.startswith(F.concat(block, F.lit("["))))


def concerned(path: Column, critical: Column, conflicts: Column) -> Column:
    """The messages that a path is about, each once: critical ones that name it, and all conflicts for partners.

    Null arrays and null messages count as none.
    """
    named = F.filter(_some(critical), lambda m: m.contains(path) | ((path == PARTNERS) & (m.contains("g_protein") | F.lower(m).contains("g-protein"))))
    return F.array_distinct(F.concat(F.when(path.contains(PARTNERS), _some(conflicts)).otherwise(F.array().cast("array<string>")), named))


def significant(block: Column, paths: Column, critical: Column, conflicts: Column) -> Column:
    """Whether a block needs a reviewer: a message is about it, or runs differ in it on more than trivial names."""
    return (F.size(concerned(block, critical, conflicts)) > 0) | F.exists(below(paths, block), lambda p: (last_name(p) != "") & ~last_name(p).isin(*TRIVIAL))


def open_to_all(paths: Column, critical: Column, conflicts: Column) -> Column:
    """Whether a record may be accepted as a whole: no message and no path on which runs differ."""
    return F.size(F.concat(_some(paths), _some(critical), _some(conflicts))) == 0


def node_decision(path: Column, paths: Column, critical: Column, conflicts: Column, issues_only: bool) -> Column:
    """What happens to a node: the best run's value is taken, it stays, or it is reviewed."""
    quiet = F.size(concerned(path, critical, conflicts)) == 0
    trivial = last_name(path).isin(*TRIVIAL) & F.array_contains(_some(paths), path) & quiet
    return waterfall((trivial, "auto_resolve_trivial"), (F.lit(issues_only) & (F.size(below(paths, path)) == 0) & quiet, "keep"), default="review")


def block_decision(block: Column, paths: Column, critical: Column, conflicts: Column, issues_only: bool = True) -> Column:
    """What happens to a block: accepted as clean, accepted once its trivial paths are resolved, or reviewed."""
    accepted = F.lit(issues_only) & ~significant(block, paths, critical, conflicts)
    return waterfall((accepted & (F.size(below(paths, block)) > 0), "auto_accept_trivial_block"), (accepted, "auto_accept_clean_block"), default="review")


def verified(records: DataFrame, entity: str = "entity", v: str = "v") -> DataFrame:
    """entity, path of the fields that the blocks of a record (VARIANT) list as verified; blocks that aren't objects list none."""
    blocks = records.select(entity, F.explode(F.try_variant_get(v, "$", "map<string,variant>")).alias("block", "b"))
    fields = blocks.select(entity, "block", F.explode(F.try_variant_get("b", "$._verified_fields", "array<string>")).alias("field"))
    return fields.select(entity, F.concat_ws(".", "block", "field").alias("path")).distinct()


def coerced(original: Column, said: Column) -> Column:
    """A reviewer's text as a VARIANT of the type that the value had before, or as it is where it doesn't parse.

    Booleans know true, yes, 1 and false, no, 0; lists and objects are JSON. What replaces null or a text is text.
    """
    kind, low, bare = F.schema_of_variant(original), F.lower(said), F.trim(said)
    parsed = F.try_parse_json(said)
    nested = F.substring(F.schema_of_variant(parsed), 1, 5)
    flag = F.when(low.isin("true", "1", "yes"), True).when(low.isin("false", "0", "no"), False)
    whole = F.when(bare.rlike(r"^[+-]?[0-9]+$"), bare).try_cast("long")
    typed = (
        F.when(kind == "BOOLEAN", flag.cast("variant"))
        .when(kind == "BIGINT", whole.cast("variant"))
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), bare.try_cast("double").cast("variant"))
        .when(kind.startswith("ARRAY") & (nested == "ARRAY") | kind.startswith("OBJECT") & (nested == "OBJEC"), parsed)
    )
    same = (kind == "VOID") & (said == "None")
    return F.when(same, original).otherwise(F.coalesce(typed, said.cast("variant")))


def default_candidate(candidates: Column) -> Column:
    """The place (from 0) of the candidate offered first: a verified one, else the majority's, else the best run's, else the first.

    candidates: structs with verified, majority and best; null flags are false. Null for an empty list.
    """
    def first(flag: str) -> Column:
        at = F.array_position(F.transform(candidates, lambda c: F.coalesce(c[flag], F.lit(False))), True)
        return F.when(at > 0, at - 1)

    return F.when(F.size(candidates) > 0, F.coalesce(first("verified"), first("majority"), first("best"), F.lit(0)).cast("int"))


def highlighted(oligo: Column, chain: Column) -> Column:
    """Whether an oligomer analysis needs a look: a corrected chain, an alert, several receptors or chains, incomplete segments."""
    kinds = F.transform(oligo["alerts"], lambda a: a["type"])
    told = F.exists(kinds, lambda k: k.isin("HALLUCINATION", "MISSED_PROTOMER", "CHAIN_ID_OVERRIDDEN", "SUSPICIOUS_7TM"))
    poor = F.exists(oligo["all_gpcr_chains"], lambda c: c["7tm_status"] == "INCOMPLETE_7TM")
    reasons = (oligo["chain_id_override"]["applied"], told, oligo["classification"].isin("HOMOMER", "HETEROMER"), F.contains(chain, F.lit(",")), poor)
    no = F.lit(False)
    return oligo.isNotNull() & F.exists(F.array(*[F.coalesce(r, no) for r in reasons]), lambda r: r)


def loaded(records: DataFrame, differences: DataFrame, reports: DataFrame) -> DataFrame:
    """records with ``controversies``, a map of paths to differences (of a path that comes twice the one largest in text),
    and ``critical`` and ``conflicts``; what is missing is empty."""
    last = differences.groupBy("entity", "path").agg(F.max(F.struct("majority_value", "best_value")).alias("d"))
    maps = last.groupBy("entity").agg(F.map_from_entries(F.collect_list(F.struct("path", "d"))).alias("controversies"))
    found = records.join(maps, "entity", "left").join(reports.select("entity", "critical", "conflicts"), "entity", "left")
    none, empty = F.array().cast("array<string>"), F.map_from_entries(F.array().cast("array<struct<path:string,d:struct<majority_value:string,best_value:string>>>"))
    return found.withColumns({"controversies": F.coalesce("controversies", empty), "critical": F.coalesce("critical", none), "conflicts": F.coalesce("conflicts", none)})
