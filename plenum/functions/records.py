"""Clean-up of fresh records, held as VARIANT: empty blocks go, names become standard ones, entry names lower case."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import NULL_LIKE

#: Spellings of one helper protein, what else stands for an absent block, and the message for no record.
SPELLINGS = {"Nb35": "Nanobody-35", "Nanobody 35": "Nanobody-35", "nb35": "Nanobody-35", "Nanobody35": "Nanobody-35"}
ABSENT = ("not present", "missing")
NO_RECORD = "Root object is not a dictionary"


def _object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def _text(v: Column) -> Column:
    """The text of a VARIANT that is one; null for all others."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _written(fields: Column, made: dict[str, Column]) -> Column:
    """A map of VARIANTs with the fields in made that aren't null in place of its own. Each part is evaluated once."""
    new = F.create_map(*[x for k, c in made.items() for x in (F.lit(k), c)])
    return F.map_filter(F.map_zip_with(fields, new, lambda k, x, y: F.coalesce(y, x)), lambda k, x: x.isNotNull())


def written(v: Column, made: dict[str, Column]) -> Column:
    """A record with the fields in made (VARIANTs) that aren't null in place of its own; what is no object stays as it is."""
    return F.coalesce(F.to_variant_object(_written(_object(v), made)), v)


def patched(v: Column, name: str, made: dict[str, Column]) -> Column:
    """A record whose object ``name`` has the fields in made (VARIANTs) that aren't null; one that lacks the object gets it.

    What stands under the name but is no object stays as it is, and so does a record that is none.
    """
    none = F.map_filter(F.create_map(F.lit(""), F.lit(None).cast("variant")), lambda k, x: F.lit(False))
    inner = F.try_variant_get(v, f"$.{name}", "variant")
    old = F.when(inner.isNull(), none).otherwise(_object(inner))
    return written(v, {name: F.to_variant_object(_written(old, made))})


def item_fields(v: Column, name: str, found: Column, made) -> Column:
    """A record whose list ``name`` has fields written into its items: made gives those of an item from its entry in found."""

    def one(item, c):
        return F.when(c.isNull(), item).otherwise(written(item, made(c)))

    items = F.try_variant_get(v, f"$.{name}", "array<variant>")
    return written(v, {name: F.to_variant_object(F.zip_with(items, found, one))})


def standard_name(name: Column) -> Column:
    """A helper protein's usual name, where its spelling is a known one. Both patterns are fixed values."""
    known = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    number = F.regexp_extract(name, r"(?i)^nb\s*-?\s*(\d+)$", 1)
    fused = name.rlike(r"(?i)\bbril\b") | (F.lower(name) == "cytochrome b562 ril")
    return F.coalesce(F.try_element_at(known, name), F.when(fused, "BRIL"), F.when(number != "", F.concat(F.lit("Nanobody-"), number)), name)


def says_nothing(v: Column) -> Column:
    """Whether a VARIANT is null, an empty list, object or text, or a text that stands for no value."""
    text = F.lower(F.btrim(_text(v), F.lit(" \t\n\r\v\f")))
    return v.isNull() | F.to_json(v).isin("null", "[]", "{}") | F.coalesce(text.isin(*NULL_LIKE, *ABSENT), F.lit(False))


def lowered(v: Column, name: str) -> Column:
    """A VARIANT with all texts under a name, at any depth, in lower case.

    Inside a JSON text a quote is escaped, so a name with its own quotes can only be a key.
    """
    mark, parts = f'"{name}":"', F.split(F.to_json(v), rf'\Q"{name}":"\E')
    own = r'^((?:[^"\\]++|\\.)*+)'

    def part(p, i):
        head = F.regexp_extract(p, own, 1)
        return F.when(i == 0, p).otherwise(F.concat(F.lit(mark), F.lower(head), F.substring(p, F.length(head) + 1, F.length(p))))

    return F.parse_json(F.array_join(F.transform(parts, part), ""))


def cleaned(v: Column) -> Column:
    """A fresh record (VARIANT) without partners that say nothing but a note, with standard names and lower-case entry names.

    What is no object becomes one with an error and the value; null stays null.
    """

    def named(item):
        fields = _object(item)
        return F.when(fields.isNotNull(), F.to_variant_object(F.transform_values(fields, lambda k, x: F.coalesce(F.when(k == "name", standard_name(_text(x)).cast("variant")), x)))).otherwise(item)

    def helpers(x):
        return F.to_variant_object(F.transform(F.try_variant_get(x, "$", "array<variant>"), named))

    def silent(x):
        return F.coalesce(F.forall(F.map_values(F.map_filter(_object(x), lambda k, y: k != "note")), says_nothing), F.lit(False))

    fields = F.map_filter(_object(v), lambda k, x: ~((k == "signaling_partners") & silent(x)))
    fields = F.transform_values(fields, lambda k, x: F.coalesce(F.when(k == "auxiliary_proteins", helpers(x)), x))
    wrong = F.to_variant_object(F.struct(F.lit(NO_RECORD).alias("error"), v.alias("raw")))
    return F.when(v.isNull(), F.lit(None).cast("variant")).when(fields.isNull(), wrong).otherwise(lowered(F.to_variant_object(fields), "uniprot_entry_name"))
