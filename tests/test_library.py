"""Small cases of the library's operators, files and streams."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from plenum.functions import text
from plenum.operators import consensus, intervals, reference, report, tree
from plenum.sources import files
from plenum.streaming import watch


def records(spark, *runs):
    return spark.createDataFrame([("e", i, json.dumps(r)) for i, r in enumerate(runs)], "e string, i long, t string").select("e", "i", F.parse_json("t").alias("v"))


def test_tree_votes_follow_the_first_record(spark):
    runs = records(
        spark,
        {"a": 1, "b": {"x": "p", "note": "n1"}, "ligands": [{"id": "L1", "role": "q"}, {"role": "lost"}], "l": [1, 2]},
        {"a": 2, "b": {"x": "q"}, "ligands": [{"id": "L1", "role": "r"}, {"id": "L2", "role": "s"}], "l": [1, 2]},
        {"a": 2, "b": "no object", "ligands": "no list", "l": [2]},
        {"a": 1, "b": {"x": "q", "y": None}},
    )
    votes, winners = tree.majority(runs, "e", "i", keyed={"ligands": "id"}, soft=("note",))
    got = {r["path"]: (r["winner"], r["votes"], r["voters"]) for r in winners.collect()}
    assert got == {"a": ("1", 2, 4), "b.x": ('"q"', 2, 3), "b.y": ("null", 3, 3), "l": ("[1,2]", 2, 4), "ligands[L1].id": ('"L1"', 2, 2), "ligands[L1].role": ('"q"', 1, 2), "ligands[L2].id": ('"L2"', 1, 1), "ligands[L2].role": ('"s"', 1, 1)}
    assert votes.agg(F.sum("n")).first()[0] == sum(v for _, _, v in got.values())


def plain_vote(values, path, keyed, soft):
    """The majority of some values, straight from the rules; what is hidden or has no votes is None."""
    if path.split(".")[-1] in soft:
        return None
    first = values[0]
    field = next((f for part, f in keyed.items() if part in path), None)
    if isinstance(first, list) and first and isinstance(first[0], dict) and field:
        items = [x for v in values if isinstance(v, list) for x in v if isinstance(x, dict) and x.get(field)]
        return [plain_vote([x for x in items if x[field] == k], f"{path}[{k}]", keyed, soft) for k in sorted({x[field] for x in items})]
    if isinstance(first, dict):
        owners = [v for v in values if isinstance(v, dict)]
        return {k: plain_vote([v.get(k) for v in owners], f"{path}.{k}" if path else k, keyed, soft) for k in sorted({k for v in owners for k in v})}
    texts = [json.dumps(v, sort_keys=True) for v in values]
    return json.loads(max(texts, key=lambda t: (texts.count(t), -texts.index(t))))


def plain_score(run, want):
    if isinstance(want, dict):
        return sum(plain_score(run.get(k), w) for k, w in want.items()) if isinstance(run, dict) else 0
    if isinstance(want, list):
        return sum(x in want for x in run) if isinstance(run, list) else 0
    return int(want is not None and run == want)


def some_value(r, depth):
    kind = r.random()
    if depth and kind < 0.3:
        return {k: some_value(r, depth - 1) for k in r.sample(["a", "b", "note", "ligands"], r.randrange(4))}
    if depth and kind < 0.5:
        return [{"id": r.choice(["x", "y", ""]), "b": some_value(r, depth - 1)} if r.random() < 0.8 else r.choice([1, "s"]) for _ in range(r.randrange(3))]
    return r.choice([None, "p", "q", 1, 2, [1, 2], [2]])


def test_best_record_is_that_of_the_rules(spark):
    r = random.Random(1)
    entities = {}
    for e in range(60):
        shapes = [{"a": some_value(r, 3), "ligands": some_value(r, 3), "b": {"x": some_value(r, 2)}} for _ in range(3)]
        entities[f"e{e}"] = [r.choice(shapes) if r.random() < 0.8 else {"a": some_value(r, 2)} for _ in range(r.randrange(1, 6))]
    rows = [(e, i, json.dumps(v)) for e, runs in entities.items() for i, v in enumerate(runs)]
    runs = spark.createDataFrame(rows, "e string, i long, t string").select("e", "i", F.parse_json("t").alias("v"))
    keyed, soft = {"ligands": "id"}, ("note",)
    major = tree.majority_record(runs, "e", "i", keyed=keyed, soft=soft)
    best = {x["e"]: (x["i"], x["score"]) for x in tree.best_record(runs, major, "e", "i").collect()}
    got = {x["e"]: json.loads(x["t"]) for x in major.select("e", F.to_json("majority").alias("t")).collect()}
    for e, own in entities.items():
        want = plain_vote(own, "", keyed, soft)
        assert got[e] == want, e
        scores = [plain_score(v, want) for v in own]
        assert best[e] == (scores.index(max(scores)), max(scores)), e


def test_differences_of_the_best_record(spark):
    runs = records(
        spark,
        {"a": {"x": 1, "m": "old", "note": "n"}, "ligands": [{"id": "L", "role": "p"}, {"id": "L", "role": "q"}], "b": "text", "l": [1]},
        {"a": {"x": 2, "m": "new"}, "ligands": [{"id": "L", "role": "q"}, {"id": "M", "role": "r"}], "b": "text", "l": [2]},
        {"a": {"x": 2, "m": "new", "y": 5}, "ligands": [{"id": "L", "role": "q"}], "l": [2]},
        {"a": {"x": 2, "m": "new", "y": 5}, "b": "other", "l": [2]},
        {"a": {"x": 2, "m": "new", "y": 5}, "b": "other", "l": [2]},
    )
    keyed = {"ligands": "id"}
    votes, _ = tree.majority(runs, "e", "i", keyed=keyed, soft=("note",))
    major = tree.majority_record(runs, "e", "i", keyed=keyed, soft=("note",))
    found = tree.differences(runs.where("i = 0"), major, votes, "e", keyed=keyed, soft=("note",), excluded=("a.m",))
    # the list l and item M, which the record lacks, say nothing; b is a tie that the first value wins; of two items L the last counts
    assert sorted(tuple(r)[1:] for r in found.collect()) == [("a.x", "1", "2", 4), ("a.y", "null", "5", 3)]
    found = tree.differences(runs.where("i = 3"), major, votes, "e", keyed=keyed, excluded=("a.m",))
    assert sorted(tuple(r)[1:] for r in found.collect()) == [("b", '"other"', '"text"', 2)]


def test_walks_have_no_depth_of_their_own(spark):
    deep, flat = {"k": 1}, {"k": 2}
    for _ in range(90):
        deep = {"d": deep}
    df = records(spark, deep, deep, flat)
    _, winners = tree.majority(df, "e", "i")
    got = {r["path"]: r["winner"] for r in winners.collect()}
    assert got[".".join(["d"] * 90 + ["k"])] == "1" and got["k"] == "null"
    assert tree.nodes(df, ["i"]).where("i = 0").count() == 91
    assert tree.nodes(df.limit(0), ["i"]).count() == 0 and tree.majority(df.limit(0), "e", "i")[1].count() == 0


def test_no_join_of_trees_goes_by_way_of_the_driver(spark):
    runs = records(spark, {"a": 1, "b": {"x": "p"}}, {"a": 2, "b": {"x": "q"}}, {"a": 2})
    votes, winners = tree.majority(runs, "e", "i")
    major = tree.majority_record(runs, "e", "i")
    best = tree.best_record(runs, major, "e", "i")
    for df in (winners, major, best, tree.differences(best, major, votes, "e")):
        df.collect()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_tree_walk_names_every_node(spark):
    got = {(r["path"], r["kind"], r["value"]) for r in tree.nodes(records(spark, {"a": [{"k": 1}, 2], "b": {"c": None}}), ["e", "i"]).collect()}
    assert got == {("a", "array", '[{"k":1},2]'), ("a[0]", "object", '{"k":1}'), ("a[0].k", "scalar", "1"), ("a[1]", "scalar", "2"), ("b", "object", '{"c":null}'), ("b.c", "scalar", "null")}


def test_ties_go_to_what_is_seen_first(spark):
    df = spark.createDataFrame([("g", 3, "x"), ("g", 1, None), ("g", 2, "x"), ("g", 0, None)], "k string, o long, f string")
    assert tuple(consensus.majority(df, ["k"], "f", "o").first()) == ("g", None, 2, 4)
    assert consensus.differences(df, ["k"], ["f"], "o").count() == 0


def test_intervals_that_touch_merge_and_neighbours_dont(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 5, 8), (1, 9, 10), (1, 20, 30), (1, 22, 23)], "k long, b long, e long")
    assert sorted(tuple(r)[1:3] for r in intervals.merge(df, ["k"], "b", "e").collect()) == [(0, 8), (9, 10), (20, 30)]
    wholes = spark.createDataFrame([(1, 0, 9), (1, 100, 109)], "k long, s long, t long")
    got = {r["s"]: (r["covered"], r["enough"]) for r in intervals.coverage(df, wholes, ["k"], 7, 0.5).collect()}
    assert got == {0: (10, True), 100: (0, False)}


def test_ghosts_need_something_to_compare_with(spark):
    said = spark.createDataFrame([("A",), ("B",)], "c string")
    assert [r["c"] for r in reference.ghosts(said, spark.createDataFrame([("A",)], "c string"), "c").collect()] == ["B"]
    assert reference.ghosts(said, spark.createDataFrame([], "c string"), "c").count() == 0


def test_closest_texts_are_those_of_all_comparisons(spark):
    words = ["abcd", "abce", "xbcd", "zzzz", "ab", "abcd", None]
    others = [("abcd", 3), ("abxx", 2), ("xbcz", 1), ("abcd", 5), ("q", 9)]
    made = reference.closest(spark.createDataFrame([(w,) for w in words], "t string"), spark.createDataFrame(others, "u string, n int"), "t", "u", "n", 4)
    expected = set()
    for w in set(words) - {None}:
        scores = [(sum(a == b for a, b in zip(w, u, strict=True)) if len(w) == len(u) == 4 else 0, n) for u, n in others]
        top = max(x for x, _ in scores)
        expected.add((w, top, sum(x == top for x, _ in scores), min(n for x, n in scores if x == top)))
    assert {tuple(r) for r in made.collect()} == expected


def test_rows_meet_the_block_of_their_path(spark):
    rows = spark.createDataFrame([("ligands[0].name",), ("ligandsextra.x",), ("receptor.chain",)], "path string")
    blocks = spark.createDataFrame([("ligands",), ("receptor",)], "block string")
    assert sorted(r["block"] for r in reference.under(rows, blocks).collect()) == ["ligands", "receptor"]


def test_text_functions(spark):
    df = spark.createDataFrame([(" A; B,none ", "abcd", "abxd", "fooBAR", None)], "a string, b string, c string, d string, e string")
    row = df.select(text.list_items(F.col("a")), text.hamming(F.col("b"), F.col("c")), text.capitalized(F.col("d")), text.is_empty(F.col("e")), text.sanitized(F.col("e")), text.hamming(F.col("b"), F.col("d"))).first()
    assert tuple(row) == (["A", "B"], 3, "Foobar", True, "", 0)


def test_findings_decide_what_goes(spark):
    one = spark.range(1)
    found = report.findings((one, "critical", F.lit("ligands[2].id"), "HALLUCINATION at '%s'"), (one, "warning", F.lit("ligands[3].id"), "odd '%s'"), (one, "warning", F.lit("receptor"), "odd '%s'"))
    assert {tuple(r) for r in report.impact(found).collect()} == {("ligands", 1, 2, "DELETE_BLOCK"), ("receptor", 0, 0, "CLEAN_ENTRIES")}


def test_files_and_tables(spark, tmp_path):
    runs = tmp_path / "runs" / "1ABC"
    runs.mkdir(parents=True)
    for name, content in (("run_1", '{"a": 1}'), ("run_10", '{"a": 2}'), ("run_2", "[1]"), ("run_3", "{broken")):
        (runs / f"{name}.json").write_text(content)
    got = [(r["entity"], r["run"]) for r in files.runs(spark, str(tmp_path / "runs")).orderBy("run").collect()]
    assert got == [("1ABC", "run_1"), ("1ABC", "run_10")]
    (tmp_path / "lines.jsonl").write_text('{"k": 1}\nnonsense\n\n[2]\n')
    good, bad = files.json_lines(spark, str(tmp_path / "lines.jsonl"))
    assert good.count() == 1 and bad.count() == 2
    lines = spark.createDataFrame([(" 1abc ", 0), ("# no", 1), ("", 2), ("2XYZ", 3), ("1ABC", 4)], "line string, pos long")
    assert sorted(map(tuple, files.line_list(lines).collect())) == [("1ABC", 0), ("2XYZ", 3)]
    rows = spark.createDataFrame([(1, ' a "b"\t', None)], "id long, t string, n string")
    where = str(tmp_path / "out")
    files.append_tables({"t": (where, rows), "none": (str(tmp_path / "no"), rows.limit(0))})
    files.append_tables({"t": (where, rows)})
    back = spark.read.option("sep", "\t").option("header", True).option("escape", '"').csv(where)
    assert back.count() == 2 and not (tmp_path / "no").exists()
    with pytest.raises(files.HeaderMismatch):
        files.append_tables({"t": (where, rows.drop("n"))})
    log = spark.createDataFrame([("x", "a", 1), ("x", "b", 2), ("y", "c", 1)], "id string, status string, timestamp long")
    files.append_log(log, str(tmp_path / "log"))
    now = files.current_status(spark.read.json(str(tmp_path / "log")))
    assert {(r["id"], r["status"]) for r in now.collect()} == {("x", "b"), ("y", "c")}


def test_commits_are_all_or_none(spark, tmp_path):
    rows = spark.createDataFrame([(1, True, " a\t"), (2, None, None)], "id long, flag boolean, t string")
    out = str(tmp_path / "t")
    files.append_tables({"t": (out, rows)})
    back = spark.read.option("sep", "\t").option("header", True).csv(out)
    assert sorted(tuple(r) for r in back.collect()) == [("1", "True", "a"), ("2", None, None)]
    broken = rows.withColumn("id", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        files.commit([(out, rows, "csv", {}), (str(tmp_path / "u"), broken, "json", {})])
    assert spark.read.option("sep", "\t").option("header", True).csv(out).count() == 2 and not (tmp_path / "u").exists()
    assert not [x for x in tmp_path.iterdir() if "staged" in x.name]


def test_aggregated_rows_caches_and_requests(spark, tmp_path):
    records_ = spark.createDataFrame([("e", '{"a": 1}')], "entity string, t string").select("entity", F.parse_json("t").alias("v"))
    reports = spark.createDataFrame([("e", ["w"])], "entity string, critical array<string>")
    none = spark.createDataFrame([], "entity string, path string")
    files.write_aggregated(records_, reports, none, str(tmp_path / "out"))
    assert (tmp_path / "out" / "records").exists() and not (tmp_path / "out" / "differences").exists()
    files.write_aggregated(records_, reports, spark.createDataFrame([("e", "p")], "entity string, path string"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out" / "differences")).count() == 1 and spark.read.json(str(tmp_path / "out" / "records")).count() == 2
    for n, version in ((3, 1), (5, 2)):
        files.write_cache(spark.range(n), str(tmp_path / "cache"), version)
    assert files.cached(spark, str(tmp_path / "nothing"), 1, "id long").count() == 0
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "a.json").write_text('{"id": "x", "status": "done", "timestamp": "1"}\n{broken\n[1]\n')
    assert [r["id"] for r in files.read_log(spark, str(tmp_path / "log")).collect()] == ["x"] and files.read_log(spark, str(tmp_path / "no")).count() == 0
    assert files.cached(spark, str(tmp_path / "cache"), 2).count() == 5 and files.cached(spark, str(tmp_path / "cache"), 1).count() == 0
    asked = spark.createDataFrame([("1ABC", 2, "text")], "entity string, run int, prompt string")
    files.write_requests(asked, str(tmp_path / "asked"))
    (line,) = [json.loads(x) for f in (tmp_path / "asked").glob("part-*") for x in f.read_text().splitlines()]
    assert line == {"key": "1ABC_run_2", "request": {"contents": [{"parts": [{"text": "text"}]}]}}


def test_streams_take_what_arrives_once(spark, tmp_path):
    folder = tmp_path / "papers"
    folder.mkdir()
    (folder / "1abc.pdf").write_bytes(b"%PDF-1.4")
    (folder / "other.pdf").write_bytes(b"%PDF-1.4")
    pending = spark.createDataFrame([("1ABC",), ("2XYZ",)], "id string")
    seen = watch.run_available(watch.arrivals(spark, str(folder), pending), str(tmp_path / "seen"), str(tmp_path / "check"))
    assert [(r["id"], r["valid"]) for r in seen.collect()] == [("1ABC", True)]
    (folder / "2xyz.pdf").write_bytes(b"nothing")
    seen = watch.run_available(watch.arrivals(spark, str(folder), pending), str(tmp_path / "seen"), str(tmp_path / "check"))
    assert sorted((r["id"], r["valid"]) for r in seen.collect()) == [("1ABC", True), ("2XYZ", False)]
    rows = spark.range(100).select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"), "id")
    rows.write.parquet(str(tmp_path / "events"))
    schema = StructType([StructField("ts", TimestampType()), StructField("id", LongType())])
    counts = watch.snapshot(watch.rates(spark, str(tmp_path / "events"), schema, "ts"), "rates")
    assert counts.agg(F.max("n")).first()[0] == 60
