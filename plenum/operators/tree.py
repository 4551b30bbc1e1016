"""Votes over whole nested records of any depth, the record that agrees best, and where it differs.

A record is walked once, in one pass without a shuffle, into a row per node; everything after that is aggregates and
equi-joins by entity and path, as many for a deep record as for a flat one. What several of these read is a table in the
shared folder, and joins are hinted to merge: both sides grow with the records, and texts that repeat take a fraction of
their memory in a shuffle, so that Spark would take them for small and broadcast them by way of the driver. The walk is the one thing that columns
can't express at any depth. Values are compared as canonical JSON: keys sorted, 2.0 as 2; booleans aren't numbers.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plenum.plans.tables import stored

NODE = [
    T.StructField("path", T.StringType()),
    T.StructField("above", T.ArrayType(T.StringType())),
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("inst", T.LongType()),
    T.StructField("up", T.LongType()),
    T.StructField("value", T.StringType()),
]
ROWS = 20_000


def _scalar(x) -> str:
    return json.dumps(int(x) if isinstance(x, float) and x.is_integer() else x, ensure_ascii=False)


def _walked(root, keyed: dict[str, str] | None, soft: tuple[str, ...], last: bool) -> list[tuple]:
    """(path, above, name, kind, inst, up, value) of a value and all that lies in it.

    kind is object, list, keyed, scalar or soft; nothing below a soft name is visited. above has the paths on the way,
    each marked with how the way goes on: o by a name, k by an item's key, i by a position. A list at a path that
    contains a name of ``keyed`` goes on by its items' key fields (with ``last`` only by the last item of a key);
    other lists end the walk, or without ``keyed`` go on by position.
    """
    rows: list = []

    def field_of(path: str) -> str | None:
        return next((f for part, f in (keyed or {}).items() if part in path), None)

    def visit(x, path: str, above: tuple[str, ...], name: str | None, up: int | None) -> str:
        inst = len(rows)
        rows.append(None)
        hidden = above and path.rsplit(".", 1)[-1] in soft
        kind, steps = "scalar", []
        if isinstance(x, dict):
            kind = "object"
            steps = [(k, x[k], f"{path}.{k}" if path else k, f"o:{path}") for k in sorted(x)]
        elif isinstance(x, list):
            kind, field = "list", field_of(path)
            if keyed is None:
                steps = [(None, y, f"{path}[{i}]", f"i:{path}") for i, y in enumerate(x)]
            elif field:
                kind = "keyed" if x and isinstance(x[0], dict) else "list"
                items = [(y[field] if isinstance(y[field], str) else _scalar(y[field]), y) for y in x if isinstance(y, dict) and not isinstance(y.get(field), (dict, list)) and y.get(field)]
                items = list(dict(items).items()) if last else items
                steps = [(k, y, f"{path}[{k}]", f"k:{path}") for k, y in items]
        if hidden:
            kind, steps = "soft", []
        texts = {id(y): visit(y, p, (*above, mark), k, inst) for k, y, p, mark in steps}

        def text(y) -> str:
            if id(y) in texts and isinstance(y, (dict, list)):
                return texts[id(y)]
            if isinstance(y, dict):
                return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{text(y[k])}" for k in sorted(y)) + "}"
            return "[" + ",".join(map(text, y)) + "]" if isinstance(y, list) else _scalar(y)

        whole = text(x)
        rows[inst] = (path, list(above), name, kind, inst, up, whole)
        return whole

    visit(root, "", (), None, None)
    return rows


def walk(df: DataFrame, keys: list[str], v: str = "v", keyed: dict[str, str] | None = None, soft: tuple[str, ...] = (), last: bool = False) -> DataFrame:
    """A row per node of the VARIANT column v, the record itself included: keys and what _walked() says. Null records give none."""
    some = df.where(F.col(v).isNotNull()).select(*keys, F.to_json(v).alias("__text"))
    schema = T.StructType([*some.schema.fields[:-1], *NODE])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(T.StructType(NODE))

        def made(batch, at, rows):
            own = [c.take(pa.array(at, pa.int64())) for c in batch.columns[:-1]]
            return pa.RecordBatch.from_arrays([*own, *[pa.array(x, kinds.field(i).type) for i, x in enumerate(zip(*rows, strict=True))]], names=[f.name for f in schema])

        for batch in batches:
            at, rows = [], []
            for i, text in enumerate(batch.column(len(keys)).to_pylist()):
                found = _walked(json.loads(text), keyed, soft, last)
                at += [i] * len(found)
                rows += found
                if len(rows) >= ROWS:
                    yield made(batch, at, rows)
                    at, rows = [], []
            if rows:
                yield made(batch, at, rows)

    return some.mapInArrow(run, schema)


def nodes(df: DataFrame, keys: list[str], v: str = "v") -> DataFrame:
    """keys, path, name, kind, value (canonical JSON) of every node below the records; items of lists have no name."""
    kind = F.when(F.col("kind") == "list", "array").otherwise(F.col("kind"))
    return walk(df, keys, v).where(F.size("above") > 0).select(*keys, "path", "name", kind.alias("kind"), "value")


def _shown(x, names: tuple[str, ...], most: int):
    if isinstance(x, dict):
        return {k: [*y[:most], f"... ({len(y) - most} more)"] if k in names and isinstance(y, list) and len(y) > most else _shown(y, names, most) for k, y in x.items()}
    return [_shown(y, names, most) for y in x] if isinstance(x, list) else x


def display(df: DataFrame, keys: list[str], v: str = "v", names: tuple[str, ...] = ("synonyms",), most: int = 3) -> DataFrame:
    """keys, v: records for display, in which lists under some names have their first items and a note of how many more
    there are, at any depth. Null records are left out."""
    some = df.where(F.col(v).isNotNull()).select(*keys, F.to_json(v).alias("__text"))

    def run(batches):
        for batch in batches:
            texts = [json.dumps(_shown(json.loads(t), names, most), ensure_ascii=False) for t in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=batch.schema.names)

    return some.mapInArrow(run, some.schema).select(*keys, F.parse_json("__text").alias("v"))


def _voters(df: DataFrame, entity: str, order: str, v: str, keyed: dict[str, str], soft: tuple[str, ...]) -> DataFrame:
    """entity, path, above, name, ord, nth, kind, value: all that vote at a path, in order of ord and nth.

    An object that lacks a name which another object at its path has votes null for it.
    """
    n = walk(df.select(F.col(entity).alias("e"), F.col(order).alias("ord"), F.col(v).alias("v")), ["e", "ord"], "v", keyed, soft)
    mark = F.coalesce(F.try_element_at("above", F.lit(-1)), F.lit(""))
    n = stored(n).withColumns({"by": F.substring(mark, 1, 1), "parent": F.substring(mark, 3, 1 << 30)})
    columns = ["e", "path", "above", "name", "ord", "nth", "kind", "value"]
    direct = n.where("by <> 'o'").withColumn("nth", F.col("inst")).select(*columns)
    objects = n.where("kind = 'object'").select("e", F.col("path").alias("parent"), "ord", F.col("inst").alias("nth"))
    named = n.where("by = 'o'")
    names = named.groupBy("e", "parent", "path", "name").agg(F.first("above").alias("above"), F.bool_or(F.col("kind") == "soft").alias("hidden"))
    there = named.select("e", "path", "ord", F.col("up").alias("nth"), "kind", "value")
    filled = objects.join(names.hint("merge"), ["e", "parent"]).join(there.hint("merge"), ["e", "path", "ord", "nth"], "left")
    kind = F.when(F.col("hidden"), "soft").otherwise(F.coalesce("kind", F.lit("scalar")))
    return stored(direct.unionByName(filled.withColumns({"kind": kind, "value": F.coalesce("value", F.lit("null"))}).select(*columns)))


def _branches(voters: DataFrame) -> DataFrame:
    """e, path, above, name, branch: how all are read at a path, as the first voter says, where the branches above lead there."""
    way = F.when(F.col("kind") == "list", "scalar").otherwise(F.col("kind"))
    found = stored(voters.groupBy("e", "path").agg(F.min_by(way, F.struct("ord", "nth")).alias("branch"), F.first("above").alias("above"), F.first("name").alias("name")))
    asked = found.select("e", "path", F.explode("above").alias("a")).select("e", F.col("path").alias("below"), F.substring("a", 3, 1 << 30).alias("path"), F.when(F.col("a").startswith("o"), "object").otherwise("keyed").alias("needs"))
    cut = asked.join(found.select("e", "path", "branch").hint("merge"), ["e", "path"]).where("branch <> needs").select("e", F.col("below").alias("path")).distinct()
    return found.join(cut.hint("merge"), ["e", "path"], "left_anti")


def _cast(voters: DataFrame, branches: DataFrame) -> tuple[DataFrame, DataFrame]:
    leaves = voters.select("e", "path", "ord", "nth", "value").join(branches.where("branch = 'scalar'").select("e", "path").hint("merge"), ["e", "path"])
    votes = leaves.groupBy("e", "path", "value").agg(F.count("*").alias("n"), F.min(F.struct("ord", "nth")).alias("at"))
    rank = F.struct("n", -F.col("at.ord"), -F.col("at.nth"))
    winners = votes.groupBy("e", "path").agg(F.max_by("value", rank).alias("winner"), F.max("n").alias("votes"), F.sum("n").alias("voters"))
    return votes.select("e", "path", "value", "n", F.col("at.ord").alias("first")), winners


def majority(df: DataFrame, entity: str, order: str, v: str = "v", keyed: dict[str, str] | None = None, soft: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(votes, winners) at all leaves: entity, path, value, n, first; and entity, path, winner, votes, voters.

    The first record's value at a path says how all are read there. An object: only objects go on, and a name that
    one of them lacks counts as null for it. A list of objects whose path contains a name of ``keyed``: items of
    all lists meet by that field, items without it are dropped, and the path goes on as path[key]. Anything else is
    one value, compared as canonical JSON. A soft name takes no part. Ties go to the value that is seen first.
    order is a number, no two records of an entity having the same. Null records don't vote.
    """
    voters = _voters(df, entity, order, v, keyed or {}, soft)
    votes, winners = _cast(voters, _branches(voters))
    return votes.withColumnRenamed("e", entity), winners.withColumnRenamed("e", entity)


def _assembled(rows: list[tuple[int, str, str, str, str, str]]) -> str:
    """A record as JSON from (depth, name, path, parent, branch, winner)."""
    made: dict[str, object] = {}
    for _, name, path, parent, branch, winner in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        value = {} if branch == "object" else [] if branch == "keyed" else json.loads(winner) if winner is not None else None
        if path:
            if isinstance(made[parent], dict):
                made[parent][name] = value
            else:
                made[parent].append(value)
        made[path] = value
    return json.dumps(made[""], ensure_ascii=False)


def majority_record(df: DataFrame, entity: str, order: str, v: str = "v", keyed: dict[str, str] | None = None, soft: tuple[str, ...] = ()) -> DataFrame:
    """entity, majority (VARIANT): the winners at all paths as one record; soft names are null, keyed items stand in order of keys.

    One record's worth of rows meets in a task per entity, however many records vote.
    """
    return polled(df, entity, order, v, keyed, soft)[2]


def polled(df: DataFrame, entity: str, order: str, v: str = "v", keyed: dict[str, str] | None = None, soft: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What majority() and majority_record() return, from one walk of the records."""
    voters = _voters(df, entity, order, v, keyed or {}, soft)
    branches = _branches(voters)
    votes, winners = _cast(voters, branches)
    return votes.withColumnRenamed("e", entity), winners.withColumnRenamed("e", entity), _records(branches, winners, entity)


def _records(branches: DataFrame, winners: DataFrame, entity: str) -> DataFrame:
    parent = F.substring(F.coalesce(F.try_element_at("above", F.lit(-1)), F.lit("")), 3, 1 << 30)
    rows = branches.join(winners.select("e", "path", "winner").hint("merge"), ["e", "path"], "left")
    items = rows.groupBy("e").agg(F.collect_list(F.struct(F.size("above").alias("d"), "name", "path", parent.alias("p"), "branch", "winner")).alias("rows"))

    def run(batches):
        for batch in batches:
            texts = [_assembled([tuple(r.values()) for r in rows]) for rows in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["e", "text"])

    made = stored(items.mapInArrow(run, T.StructType([items.schema["e"], T.StructField("text", T.StringType())])))
    return made.select(F.col("e").alias(entity), F.parse_json("text").alias("majority"))


def _items(text: Column) -> Column:
    """The items of a list in JSON, each as JSON; null for anything else."""
    return F.transform(F.try_variant_get(F.parse_json(text), "$", "array<variant>"), lambda x: F.to_json(x))


def scored(df: DataFrame, majorities: DataFrame, entity: str, order: str, v: str = "v") -> DataFrame:
    """entity, order, score of every record: how many of its values are the majority's.

    Along names, a value that equals the majority's and isn't null counts one; in a list each item that the majority's
    list has, whole. A record that has another type where the majority has an object gets nothing below it.
    """
    wanted = walk(majorities, [entity], "majority", {}).where("kind <> 'object' AND value <> 'null'").select(entity, "path", F.col("value").alias("want"))
    said = walk(df.select(entity, order, F.col(v).alias("v")), [entity, order], "v", {}).select(entity, order, "path", "value")
    hits = F.size(F.filter(_items(F.col("value")), lambda x: F.array_contains(_items(F.col("want")), x)))
    point = F.when(F.col("want").startswith("["), F.when(F.col("value").startswith("["), hits).otherwise(0)).otherwise((F.col("value") == F.col("want")).cast("int"))
    points = said.join(wanted.hint("merge"), [entity, "path"]).groupBy(entity, order).agg(F.sum(point.cast("long")).alias("score"))
    return df.select(entity, order).join(points.hint("merge"), [entity, order], "left").select(entity, order, F.coalesce("score", F.lit(0).cast("long")).alias("score"))


def best_record(df: DataFrame, majorities: DataFrame, entity: str, order: str, v: str = "v") -> DataFrame:
    """entity, order, score, v: each entity's record with the highest score, of equal ones the first."""
    scores = scored(df, majorities, entity, order, v)
    top = scores.groupBy(entity).agg(F.max("score").alias("score"), F.max_by(order, F.struct("score", -F.col(order))).alias(order))
    return df.select(entity, order, F.col(v).alias("v")).join(top.hint("merge"), [entity, order]).select(entity, order, "score", "v")


def differences(best: DataFrame, majorities: DataFrame, votes: DataFrame, entity: str, v: str = "v", keyed: dict[str, str] | None = None, soft: tuple[str, ...] = (), excluded: tuple[str, ...] = ()) -> DataFrame:
    """entity, path, best_value, majority_value, n where a value of the best record isn't the majority's; n votes were for that.

    Values are JSON; a name that the best record's object lacks is null. Keyed items meet by key, of equal keys in the
    best record the last. Majorities that are null, other lists, soft names, paths in excluded, items that the best
    record lacks and whatever lies where it has another type give nothing.
    """
    keyed = keyed or {}
    want = walk(majorities, [entity], "majority", keyed, soft, last=True).where("kind = 'scalar' AND value <> 'null' AND size(above) > 0")
    above = F.try_element_at("above", F.lit(-1))
    want = want.where(~F.exists(F.col("above"), lambda a: F.substring(a, 3, 1 << 30).isin(*excluded)) & ~F.col("path").isin(*excluded)) if excluded else want
    want = want.where(above.startswith("o")).select(entity, "path", F.substring(above, 3, 1 << 30).alias("parent"), F.col("value").alias("majority_value"))
    have = walk(best, [entity], v, keyed, soft, last=True)
    objects = have.where("kind = 'object'").select(entity, F.col("path").alias("parent"))
    found = want.join(objects.hint("merge"), [entity, "parent"]).join(have.select(entity, "path", F.col("value").alias("best_value")).hint("merge"), [entity, "path"], "left")
    found = found.withColumn("best_value", F.coalesce("best_value", F.lit("null"))).where("best_value <> majority_value")
    n = votes.select(entity, "path", F.col("value").alias("majority_value"), "n")
    return found.join(n.hint("merge"), [entity, "path", "majority_value"], "left").select(entity, "path", "best_value", "majority_value", "n")
