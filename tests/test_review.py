"""Review decisions, corrected chains and the state of papers, rule by rule, with nulls."""

import itertools

from pyspark.sql import functions as F

from plenum.operators import acquisition, review, structures

TRIVIAL = set(review.TRIVIAL)
PATHS = "array<string>"


def plain_below(paths, block):
    return [p for p in paths or [] if p is not None and (not block or p == block or p.startswith((block + ".", block + "[")))]


def test_blocks_and_nodes(spark):
    blocks = ["", "ligands", "ligands[0].synonyms", "signaling_partners", "receptor_info.chain_id"]
    paths = [None, [], ["ligands[0].synonyms"], ["ligands[0].role", None], ["ligandsx"], ["receptor_info.chain_id"], ["signaling_partners.g_protein.source"]]
    critical = [None, ["x at 'ligands[0]'"], ["bad G-Protein", None], ["at 'receptor_info.chain_id'"]]
    conflicts = [None, ["c", "c"]]
    rows = [(i, *r) for i, r in enumerate(itertools.product(blocks, paths, critical, conflicts))]
    df = spark.createDataFrame(rows, f"i int, b string, p {PATHS}, w {PATHS}, c {PATHS}")
    b, p, w, c = (F.col(x) for x in "bpwc")
    got = {r["i"]: r for r in df.select("i", review.concerned(b, w, c).alias("m"), review.block_decision(b, p, w, c).alias("block"), review.node_decision(b, p, w, c, True).alias("node"), review.node_decision(b, p, w, c, False).alias("all"), review.open_to_all(p, w, c).alias("open")).collect()}
    for i, block, ps, ws, cs in rows:
        ws_, cs_ = [x for x in ws or [] if x], cs or []
        messages = list(dict.fromkeys((cs_ if "signaling_partners" in block else []) + [x for x in ws_ if block in x or (block == "signaling_partners" and ("g_protein" in x or "g-protein" in x.lower()))]))
        inside = plain_below(ps, block)
        names = [x.split(".")[-1].split("[")[0] for x in inside]
        want = "review" if messages or any(n not in TRIVIAL for n in names) else "auto_accept_trivial_block" if inside else "auto_accept_clean_block"
        name = block.split(".")[-1].split("[")[0]
        trivial = name in TRIVIAL and block in (ps or []) and not messages
        assert (got[i]["m"], got[i]["block"]) == (messages, want), rows[i]
        assert got[i]["node"] == ("auto_resolve_trivial" if trivial else "keep" if not inside and not messages else "review"), rows[i]
        assert got[i]["all"] == ("auto_resolve_trivial" if trivial else "review"), rows[i]
        assert got[i]["open"] == (not [x for x in ps or [] if x] and not ws_ and not cs_), rows[i]


def test_verified_paths_and_edits(spark):
    docs = [("a", '{"x": {"_verified_fields": ["f", "g", "f"]}, "y": [1], "z": {"_verified_fields": "f"}}'), ("b", "[1]"), ("c", "{}")]
    df = spark.createDataFrame(docs, "entity string, t string").select("entity", F.parse_json("t").alias("v"))
    assert sorted(map(tuple, review.verified(df).collect())) == [("a", "x.f"), ("a", "x.g")]
    edits = [("true", "No", "false"), ("true", "maybe", '"maybe"'), ("1", "25", "25"), ("1", "2.5", '"2.5"'), ("1.5", "2", "2.0"), ("1.5", "x", '"x"'), ("[1]", "[2, 3]", "[2,3]"), ("[1]", '{"a":1}', '"{\\"a\\":1}"'), ('{"a":1}', '{"a":2}', '{"a":2}'), ('"s"', "1", '"1"'), ("null", "None", "null"), ("null", "n", '"n"'), ("[1]", "[", '"["')]
    df = spark.createDataFrame(edits, "o string, s string, want string").select("want", F.to_json(review.coerced(F.parse_json("o"), F.col("s"))).alias("got"))
    assert [r["got"] for r in df.collect()] == [e[2] for e in edits]


def test_corrected_chains(spark):
    kind = "i int, chain string, name string, suggested string, members array<struct<chain:string,slug:string,status:string>>, alerts array<struct<type:string,chains:array<string>>>"
    two = [("A", "aa_human", "INCOMPLETE_7TM"), ("B", "bb_human", "COMPLETE")]
    invented = [("HALLUCINATION", ["C"])]
    rows = [(0, "A", "x", "B", two, []), (1, "C", "x", "A", two, invented), (2, "A", "x", "A", two, invented), (3, None, "x", "A", two, invented), (4, "A", "x", None, two, None), (5, "B", "x", "A", two, None), (6, "C", "x", "A", [("A", None, "UNKNOWN")], invented), (7, "A", None, "B", [], None)]
    df = spark.createDataFrame(rows, kind).select("i", structures.override(*map(F.col, ("chain", "name", "suggested", "members", "alerts"))).alias("o")).select("i", "o.*")
    got = {r["i"]: (r["trigger"], r["corrected_chain_id"], r["corrected_uniprot"]) for r in df.collect()}
    assert got == {0: ("7TM_UPGRADE", "B", "bb_human"), 1: ("HALLUCINATION", "A", "aa_human"), 2: (None, "A", "x"), 3: (None, None, "x"), 4: (None, "A", "x"), 5: (None, "B", "x"), 6: ("HALLUCINATION", "A", "x"), 7: (None, "A", None)}


def test_fusions(spark):
    kind = "members array<struct<chain:string,slug:string>>, proteins map<string,array<struct<name:string,n:long>>>, slugs map<string,string>"
    slugs = {"P1": "grm7_rat", "P2": "mtor_human", "P3": "adrb2_human"}
    proteins = {"A": [("P2", 0), ("P1", 7)], "B": [("P1", 7)], "C": [("P2", 9), ("P1", 7)], "D": [("P9", 7), ("P1", 1)], "E": [("P1", 0), ("P3", 0)], "F": [("P3", 7), ("P1", 7)]}
    rows = [([(c, "old") for c in "ABCDEFG"], proteins, slugs)]
    r = spark.createDataFrame(rows, kind).select(structures.refined(F.col("members"), F.col("proteins"), F.col("slugs")).alias("m")).first()
    assert [x["slug"] for x in r["m"]] == ["grm7_rat", "old", "old", "old", "old", "adrb2_human", "old"]


def test_papers_and_requests(spark):
    names = ("has_entry", "has_file", "readable", "contact", "doi", "pmid", "pmcid", "open_url", "archive_url", "abstract", "file_ok")
    full = dict(has_entry=True, has_file=False, readable=True, contact=True, doi="d", pmid="1", pmcid="c", open_url="u", archive_url="v", abstract="a", file_ok=True)
    cases = [({}, "success_pdf_downloaded", "unpaywall_pdf"), ({"open_url": ""}, "success_pdf_downloaded", "ncbi_pmc_oa_pdf"), ({"open_url": None, "pmcid": None}, "fallback_abstract_only", "ncbi_abstract"), ({"file_ok": None, "pmid": None}, "fallback_paywalled", None), ({"doi": ""}, "failed_no_doi", None), ({"contact": None}, "failed_no_data", None), ({"has_file": True, "readable": False}, "skipped_already_downloaded", None), ({"has_entry": None}, "skipped_no_enriched_data", None)]
    schema = ", ".join(f"{n} {'boolean' if isinstance(full[n], bool) else 'string'}" for n in names)
    df = spark.createDataFrame([(i, *((full | c[0])[n] for n in names)) for i, c in enumerate(cases)], "i int, " + schema)
    got = sorted((r["i"], r["status"], r["source"]) for r in acquisition.paper_status(df).collect())
    assert got == [(i, s, o) for i, (_, s, o) in enumerate(cases)]
    assert acquisition.paper_status(df, force=True).where("i = 6").first()["status"] == "failed_no_data"
    log = spark.createDataFrame([("a", "fallback_paywalled"), ("b", "fallback_paywalled"), ("c", "failed_no_doi")], "id string, status string")
    assert sorted(map(tuple, acquisition.after_arrival(log, spark.createDataFrame([("a",), ("a",), ("c",)], "id string"), "id").collect())) == [("a", "manual_user_provided"), ("b", "fallback_paywalled"), ("c", "failed_no_doi")]
    targets, done = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "id string"), spark.createDataFrame([("x", 2), ("z", 1)], "id string, run long")
    assert sorted(map(tuple, acquisition.requests(targets, done, "id", 2).collect())) == [("x", 1), ("y", 1), ("y", 2)]
    papers = spark.createDataFrame([("d", ["c", "a", "b", None, "a"])], "doi string, ids array<string>")
    entries = spark.createDataFrame([("a", "d"), ("q", None), ("r", "e")], "id string, doi string")
    assert sorted(map(tuple, acquisition.siblings(entries, papers, "id", "doi").collect())) == [("a", ["b", "c"]), ("q", []), ("r", [])]
    texts = spark.createDataFrame([(">h\nMK\nT \r\nA",), (">h",), ("",), (None,)], "t string")
    assert [r["s"] for r in texts.select(acquisition.sequence_of(F.col("t")).alias("s")).collect()] == ["MKTA", None, None, None]
