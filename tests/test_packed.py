import json
import os
import random

import pandas as pd

from graphloom.operators import packed

A, B, C = (f"doc-{c * 32}-chunk-00{i}" for i, c in enumerate("abc"))


def best(kind, text):
    c = packed.candidates(kind, text)
    return min(c, key=lambda x: (sum(x[1]) + len(x[0]), len(x[0])))[0] if c else []


def test_delimiters_of_references():
    for text in (f"{A}<SEP>{B}", f"{A}; {B}", f'["{A}", "{B}"]', f"'{A}', '{B}'", f'"{A}","{B}"', f"{A}\n{B}", f"{A} <sep> {B}", f"<SEP>{A}<SEP><SEP>{B}", f"{A}| |{B}|"):
        assert best("source_id", text) == [A, B], text
    assert best("source_id", f"{A}; {B}|{C}") == [A, B, C]
    assert best("source_id", f" {A}") == [A]


def test_files_keep_their_own_signs():
    x, y = "Seasonal, reservoir - 1968 47872e.pdf", "Layered; notes a90339.docx"
    assert best("file_path", f"{x}<SEP>{y}") == [x, y]
    assert best("file_path", f'"{x}", {y}') == [x, y]
    assert best("file_path", x) == [x]


def test_keywords_in_quotes():
    assert best("properties", '"trade, polar"; archive; "graph"') == ["trade, polar", "archive", "graph"]
    assert best("properties", '["trade, polar", "reef"]') == ["trade, polar", "reef"]
    assert best("properties", '"kernel, shallow"') == ["kernel, shallow"]


def test_null_blank_and_unclosed():
    assert packed.candidates("source_id", None) == []
    assert best("source_id", "   ") == []
    assert best("properties", "it's; fine") == ["it's", "fine"]


def test_table(spark, rows):
    fields = spark.createDataFrame([("t", 1, "source_id", f"{A};{B}"), ("t", 2, "properties", "reef, lichen"), ("t", 3, "properties", "reef"), ("t", 4, "properties", "lichen"), ("t", 5, "properties", "reef"), ("t", 6, "properties", "lichen"), ("t", 7, "file_path", ""), ("t", 8, "source_id", None)], "tbl string, gid long, field string, packed string")
    got = rows(packed.values_of(packed.parse_packed(fields)).where("n_items > 1"), "gid", "pos", "item")
    assert got == [(1, 1, A), (1, 2, B), (2, 1, "reef"), (2, 2, "lichen")]
    assert packed.values_of(packed.parse_packed(fields.limit(0))).count() == 0


def test_lists_of_any_length_and_mixed_separators():
    refs = [f"doc-{i:032x}-chunk-{i:03d}" for i in range(50)]
    for n in (2, 3, 6, 7, 20, 50):
        for a in packed.SEPARATORS:
            assert best("source_id", a.join(refs[:n])) == refs[:n], (n, a)
            for b in (";", ",", "|", "<SEP>"):
                assert best("source_id", a.join(refs[: n - 1]) + b + refs[n - 1]) == refs[:n], (n, a, b)
    assert best("source_id", ",".join(refs[:6]) + "; " + refs[6]) == refs[:7]
    assert best("source_id", f"{A};{B}|{C},{refs[0]}<SEP>{refs[1]}\n{refs[2]}") == [A, B, C, *refs[:3]]
    assert best("properties", "reef; coral|tide\nkelp、sand") == ["reef", "coral", "tide", "kelp", "sand"]


def test_evident_agrees_with_the_prices():
    """Wherever a field goes unpriced, pricing leaves that parse alone in the race whatever the code book holds."""
    rng, n = random.Random(5), 0
    words = {"source_id": [A, B, C, "UNKNOWN"], "file_path": ["a, b.pdf", "Report x.docx", "unknown_source"], "properties": ["reef", "deep, sea", "a b", "x"]}
    fields = [(kind, rng.choice(["", " "]) + s.join(rng.choice(w) for _ in range(rng.randint(1, 12)))) for kind, w in words.items() for s in packed.SEPARATORS for _ in range(60)]
    for d in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        for t in ("graph_nodes", "graph_edges"):
            if os.path.exists(f"{d}/{t}.parquet"):
                p = pd.read_parquet(f"{d}/{t}.parquet", columns=["source_id", "file_path", "properties"])
                p["properties"] = [json.loads(x).get("keywords") if x else None for x in p["properties"]]
                fields += [(k, x) for k in p for x in set(p[k].dropna())]
    for kind, text in fields:
        plain = packed.evident(kind, text)
        if plain:
            n += 1
            assert [items for items, _ in packed.priced(kind, text)] == [plain], (kind, text)
    assert n > 300
