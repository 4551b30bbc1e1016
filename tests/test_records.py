"""Clean-up of fresh records."""

import json

from pyspark.sql import functions as F

from plenum.functions import records

CASES = [
    ({"a": None, "signaling_partners": {"note": "x", "g": None, "h": {}, "i": [], "j": " N/A\n", "k": "Not Present"}}, {"a": None}),
    ({"signaling_partners": {}}, {}),
    ({"signaling_partners": None, "auxiliary_proteins": "x"}, {"signaling_partners": None, "auxiliary_proteins": "x"}),
    ({"signaling_partners": {"g": {"a": None}}}, {"signaling_partners": {"g": {"a": None}}}),
    ({"signaling_partners": {"g": 0}}, {"signaling_partners": {"g": 0}}),
    (
        {"auxiliary_proteins": [{"name": n, "t": 1} for n in ("Nb35", "NB - 12", "nb6", "thermostable BriL", "Cytochrome b562 RIL", "Brilliant", "nb", "", None, 5)] + ["Nb35", None, {}]},
        {"auxiliary_proteins": [{"name": n, "t": 1} for n in ("Nanobody-35", "Nanobody-12", "Nanobody-6", "BRIL", "BRIL", "Brilliant", "nb", "", None, 5)] + ["Nb35", None, {}]},
    ),
    (
        {"r": {"uniprot_entry_name": 'A\\"B_HUMAN', "o": "KEEP"}, "l": [{"uniprot_entry_name": ""}, {"uniprot_entry_name": None}], "t": 'x "uniprot_entry_name":"ABC"', "uniprot_entry_name": "ÄX"},
        {"r": {"uniprot_entry_name": 'a\\"b_human', "o": "KEEP"}, "l": [{"uniprot_entry_name": ""}, {"uniprot_entry_name": None}], "t": 'x "uniprot_entry_name":"ABC"', "uniprot_entry_name": "äx"},
    ),
    ([1], {"error": records.NO_RECORD, "raw": [1]}),
    ("s", {"error": records.NO_RECORD, "raw": "s"}),
]


def test_cleaned(spark):
    df = spark.createDataFrame([(i, json.dumps(c[0])) for i, c in enumerate(CASES)] + [(99, None)], "i int, t string")
    got = {r["i"]: r["j"] for r in df.select("i", F.to_json(records.cleaned(F.parse_json("t"))).alias("j")).collect()}
    assert got.pop(99) is None
    for i, (_, want) in enumerate(CASES):
        assert json.loads(got[i]) == want, got[i]
