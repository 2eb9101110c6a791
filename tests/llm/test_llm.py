"""Operators of the subpackage: brute force, round trips, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("graphloom.llm")
from graphloom.llm import encode, markup, mixture, names, neighbours, personal, scans, splitter  # noqa: E402


# --- 1 splitting
def test_range_maximum_against_brute_force():
    rng = np.random.default_rng(1)
    v = rng.integers(-1, 6, 200).astype(np.int8)
    table = splitter.RangeMaximum(v)
    for _ in range(500):
        a, b = sorted(rng.integers(0, 200, 2))
        best = max(range(a, b + 1), key=lambda i: (v[i], i))
        assert table.argmax(a, b) == best


@pytest.mark.parametrize("text", ["word " * 3000, "x" * 9001, "Satz. " * 900 + "\n\n" + "y" * 5000, "句子。" * 3000, "e\u0301" * 4000, "a\n\n" * 2500])
def test_pieces_cover_the_text(text):
    p = splitter.pieces(text, 480, 32)
    assert p[0][0] == 0 and p[-1][1] == len(text)
    for (a, b), (c, d) in zip(p, p[1:]):
        assert b - a <= 1920 and a < c < b and b - c <= 128 and d > b
    assert p[-1][1] - p[-1][0] <= 1920


def test_piece_limits():
    assert splitter.pieces(None, 480, 32) == [(0, 0)] and splitter.pieces("x" * 1920, 480, 32) == [(0, 1920)]
    assert len(splitter.pieces("x" * 1921, 480, 32)) == 2
    assert all(text[b - 1] == " " for text in ["One two. " * 400] for _, b in splitter.pieces(text, 480, 32)[:-1])
    with pytest.raises(ValueError):
        splitter.pieces("x", 10, 10)
    assert len(splitter.pieces("ab " * 50, 1, 0)) >= 38


def test_fresh_index(spark):
    rows = [("d", "d-chunk-000", 5, "x" * 2000), ("d", "d-chunk-001", None, "b"), ("d", "d-chunk-002", 5, None), ("e", "e-chunk-000", None, "")]
    df = spark.createDataFrame(rows, "full_doc_id string, id string, chunk_order_index int, content string")
    out = splitter.fresh_index(splitter.split(df)).orderBy("full_doc_id", "chunk_order_index").collect()
    assert [(r.full_doc_id, r.id[-3:], r.chunk_order_index) for r in out] == [("d", "001", 0), ("d", "000", 1), ("d", "000", 2), ("d", "002", 3), ("e", "000", 0)]
    assert splitter.split(df.limit(0)).count() == 0


# --- 2 names
@pytest.mark.parametrize("a,b", [("Huvetrerkis, Hettie", "Henrietta Huvetrerkis"), ("K. Babrilisan", "Katherine S. Babrilisan"), ("Devopimis EC", "Edward C. Devopimis"), ("BATEROTAN XIMENA", "Ximena Baterotan"), ("Prof. Oskar Lufègobor", "Oskar Lufegobor"), ("Stephen Bre-Pepolten", "S. Brepepolten"), ("Peggy Vohatazus", "Maggie Voatazus")])
def test_same_person(a, b):
    assert names.same_person(names.tokens(a, "person"), names.tokens(b, "person"))


@pytest.mark.parametrize("a,b", [("Matthias Bugidetis", "Stephen Bugidetis"), ("Alexander L. Fobabiran", "Alexander L. Mofavutor"), ("N. Zohihaten", "Kwame Zohihaten"), ("", "Kwame Zohihaten")])
def test_other_person(a, b):
    assert not names.same_person(names.tokens(a, "person"), names.tokens(b, "person"))


def test_organizations():
    same = lambda a, b: names.same_organization(names.tokens(a, "organization"), names.tokens(b, "organization"))
    assert same("Inst. Appl. Ling., Kinefestus", "Kinefestus Institute of Applied Linguistics")
    assert same("Stohahukor Foundation of Coasta lResearch", "Stohahukor Foundation of Coastal Research")
    assert same("Gugahozis Ctr. of Polar Ecology", "The Gugahozis Centre of Polar Ecology e.V.")
    assert not same("Razosiis Centre of Applied Linguistics", "Razosiis Department of Sediment Dynamics")


def test_symmetric_deletes_find_every_near_token():
    rng = random.Random(4)
    words = {"".join(rng.choice("abcde") for _ in range(rng.randint(8, 10))) for _ in range(150)}
    keys = {w: names.deletions(w, 2) for w in words}
    for a in words:
        for b in words:
            if names.distance(a, b, 2) <= 2:
                assert keys[a] & keys[b]


def test_links(spark, rows):
    n = [("papers", "1", "Kwame Zohihaten", "person"), ("papers", "2", "Zohihaten, K.", "person"), ("papers", "3", None, "person"), ("papers", "4", "  ", "person"), ("papers", "5", "Kwame Zohihaten", "person"), ("graph_nodes", "1", "Kwame Zohihaten", "person")]
    df = spark.createDataFrame(n, "tbl string, id string, name string, kind string")
    assert rows(names.links(df)) == [("papers", "1", "2"), ("papers", "1", "5"), ("papers", "2", "5")]
    assert names.links(df.limit(0)).count() == 0


def test_assignment_two_ways():
    rng = random.Random(3)
    for _ in range(200):
        n, m = rng.randint(1, 6), rng.randint(1, 6)
        cost = [[rng.choice([0.0, 0.2, 0.5, 1.0, names.NO]) for _ in range(m)] for _ in range(n)]
        left, right = ([rng.choice([0.4, names.NO]) for _ in range(k)] for k in (n, m))
        a, b = names.assignment(cost, left, right), names._augmenting(cost, left, right)
        assert abs(a - b) < 1e-9 or a >= names.NO and b >= names.NO


def test_names_of_many_words_are_compared_whole(spark, rows):
    long = "First Second Third Fourth Fifth Sixth Seventh Eighth Ninth Tenth Eleventh Twelfth Thirteenth Institute of"
    n = [f"{long} Glaciology", f"{long} Entomology", "Glaciology " + long, f"{long} Glacioiogy"]
    df = spark.createDataFrame([("graph_nodes", f"{i}", x, "organization") for i, x in enumerate(n)], "tbl string, id string, name string, kind string")
    assert rows(names.links(df), "id_a", "id_b") == [("0", "2"), ("0", "3"), ("2", "3")]


def test_a_name_of_many_ids_is_one_representative(spark, rows):
    df = spark.createDataFrame([("papers", f"{i}", "Kwame Zohihaten", "person") for i in range(300)] + [("papers", "x", "Zohihaten, K.", "person")], "tbl string, id string, name string, kind string")
    members, pairs = names.variants(df)
    assert members.count() == 301 and rows(pairs, "rep_a", "rep_b") == [("k zohihaten", "kwame zohihaten")] or rows(pairs, "rep_a", "rep_b") == [("kwame zohihaten", "zohihaten k")]


def test_organizations_meet_by_their_rare_words(spark, rows):
    n = ["Kinefestus Institute of Applied Linguistics", "Inst. Appl. Ling., Kinefestus", "Applied Linguistics Institute, Kiinefestus", "Nipivupus Institute of Applied Linguistics", *(f"{w} Institute of Applied Linguistics" for w in ("Razosiis", "Verifodis", "Trenurius"))]
    df = spark.createDataFrame([("graph_nodes", f"{i}", x, "organization") for i, x in enumerate(n)], "tbl string, id string, name string, kind string")
    assert rows(names.links(df), "id_a", "id_b") == [("0", "1"), ("0", "2"), ("1", "2")]


def test_organizations_of_common_words(spark, rows):
    """A name whose words all stand in more than RARE names meets its abbreviated and misspelled forms."""
    many = names.RARE + 10
    fill = [f"{w} {i:03d}x{k}" for k, w in enumerate(("Kyoto", "Polar", "Ecology", "Institute")) for i in range(many * (1 if k == 1 else 2))]
    cases = ["Kyoto Institute of Polar Ecology", "Inst. Pol. Ecol., Kyoto", "Kyoto Enstitute of Polar Ecology"]
    df = spark.createDataFrame([("t", n, n, "organization") for n in fill + cases], "tbl string, id string, name string, kind string")
    got = {frozenset((r.id_a, r.id_b)) for r in names.links(df).collect()}
    assert {frozenset((cases[0], x)) for x in cases[1:]} <= got
    assert not any(len(x & set(cases)) == 1 for x in got)


def test_no_candidate_of_common_words_is_dropped(spark):
    """Where every word stands in more than RARE names, the pairs are those of comparing all names with all."""
    kyoto, names_ = "kyoto institute polar ecology", "kyoto institute polar ecology".split()
    fill = [f"{w} {i:03d}x{k}" for k, w in enumerate([*names_, "porto", "marine"]) for i in range(names.RARE + 5)]
    cases = [
        kyoto, "kyotoinstitute polar ecology", "kyoto insti tute polar ecology", "kyot oinstitut epola recology", "kyoto institute polare cology",
        "kyoot institutep olar ecology", "kyoto isntitute polarecoogy", "kyo ins pol eco", "kto. inst. plr. eclgy", "kyoto inst polr ecol", "ecol enstitute kyoto pol", "xkyoto yinstitute polar zecology",
        "porto institute polar ecology", "porto institute marine ecology", "prt ins mar ecology", "porto institutemarin eecology", "marine", "mar", "marin",
        "kyoto polar " + " ".join(f"word{c}" for c in "abcdefghijkl"), "polar kyoto " + " ".join(f"word{c}" for c in "abcdefghijkl"),
    ]
    assert all(sum(w in x.split() for x in fill) > names.RARE for w in names_)
    df = spark.createDataFrame([("t", "organization", n) for n in fill + cases], "tbl string, kind string, rep string").distinct()
    got = {(r.rep_a, r.rep_b) for r in names.matched(df).collect() if {r.rep_a, r.rep_b} & set(cases)}
    every = sorted(fill + cases)
    true = {(a, b) for i, a in enumerate(every) for b in every[i + 1 :] if {a, b} & set(cases) and names.same_organization(a.split(), b.split())}
    assert got == true and {tuple(sorted((kyoto, x))) for x in cases[1:9]} <= true


def test_texts_within_two_edits_share_a_number():
    rng = random.Random(6)
    for size in [*range(1, 12), 35, *range(names.LONG - 2, names.LONG + 5), 150]:
        for _ in range(40):
            a = b = "".join(rng.choice("abcdé") for _ in range(size))
            for _ in range(2):
                i = rng.randrange(len(b)) if b else 0
                b = rng.choice([b[:i] + b[i + 1 :], b[:i] + "x" + b[i + 1 :], b[:i] + "b" + b[i:], b[:i] + b[i + 1 : i + 2] + b[i : i + 1] + b[i + 2 :]])
            if names.distance(a, b, 2) <= 2 and (max(len(a), len(b)) >= 8 or sorted(a) == sorted(b)):
                assert set(names.spellings(a)) & set(names.spellings(b))
    assert not set(names.spellings("kyotopolarecology")) & set(names.spellings("kyotomarineecology"))


def test_a_key_for_every_abbreviation(spark):
    rng = random.Random(7)
    pairs = {(long[: rng.randint(2, 9)] if rng.random() < 0.5 else long[0] + "".join(c for c in long[1:] if rng.random() < 0.3)[:4], long) for long in ("".join(rng.choice("abcde") for _ in range(rng.randint(4, 11))) for _ in range(300))}
    pairs = [p for p in pairs if len(p[0]) > 1 and len(p[1]) - len(p[0]) > 1]
    assert all(names._word_cost(*p) == 0.2 for p in pairs)
    for r in spark.createDataFrame(pairs, "short string, long string").withColumn("key", names.shorter(F.col("short"))).collect():
        assert r.key in names.longer(r.long)


def test_two_edits_at_the_beginning_of_a_given_name(spark, rows):
    df = spark.createDataFrame([("t", "person", x) for x in ("alexander zohihaten", "xyexander zohihaten")], "tbl string, kind string, rep string")
    assert rows(names.matched(df), "rep_a", "rep_b") == [("alexander zohihaten", "xyexander zohihaten")]


# --- 3 markup
@pytest.mark.parametrize("text,kind", [("a <b>c</b>", "html"), ("x&nbsp;y", "html"), ("# Top\n\ntext", "markdown"), ("see [x](http://a.b/c)", "markdown"), ("* a\n+ b", "markdown"), ("[[Link|x]] y", "wiki"), ("'''The''' x", "wiki"), ("== T ==", "wiki"), ("\\emph{x} y", "latex"), ("where $x_1 \\leq 2$", "latex"), ("text. % a comment", "latex")])
def test_language(text, kind):
    assert markup.language(text) == kind


@pytest.mark.parametrize("text", ["", None, "  ", "p < 0.05 and n > 30", "C# and F#", "3 * 4 * 5", "[[1, 2], [3, 4]]", "vector<float>", "a -> b", "C:\\data\\runs", "R&D", "from $40 to $60", "See [50] for", "about 9 % of it"])
def test_no_language(text):
    assert markup.language(text) is None and markup.clean(text) == (None, text)


def test_structure_stays():
    html = markup.clean("<h2>Top</h2><p>It is <b>the</b> text of a page.</p><ul><li>one</li><li>two</li></ul><pre><code>a &lt; b</code></pre><table><tr><th>y<td>1</table><script>x()</script>")[1]
    assert html == "## Top\n\nIt is the text of a page.\n\n- one\n- two\n\n```\na < b\n```\n\ny | 1"
    assert markup.clean("\\section{A}\nx \\cite{b} y\n\\begin{equation}\na = b\n\\end{equation}")[1] == "# A\n\nx y\n\n$a = b$"
    assert "{{" not in markup.clean("a{{cite|x}} [[L|b]]\n{|\n! y\n|-\n| 1\n|}")[1]


def test_links_only_blocks_go_and_short_ones_inherit():
    blocks = [markup.Block("text", "home about contact", 18), markup.Block("text", "menu"), markup.Block("text", "this is the text of the page and it is long"), markup.Block("text", "Fine")]
    assert markup.classify(blocks) == [False, False, True, True]
    assert markup.classify([]) == [] and markup.classify([markup.Block("text", "x")]) == [True]


def test_markup_table(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "<p>x</p>", "k")], "id int, content string, kind2 string")
    assert [(r.kind, r.clean) for r in markup.convert(df).orderBy("id").collect()] == [(None, None), ("html", "x")]


# --- 4 neighbours
def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(max(1, n // 12), 64))
    return np.repeat(centre, 12, axis=0)[:n] + 0.4 * rng.normal(size=(min(n, len(centre) * 12), 64))


def test_recall_against_brute_force(spark):
    v = vectors(2400)
    df = spark.createDataFrame([(f"ent-{i:032x}", v[i].tolist()) for i in range(len(v))], "id string, vector array<float>")
    got = {(r.id_a, r.id_b) for r in neighbours.pairs(neighbours.neighbours(df)).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -1)
    want = {tuple(sorted((f"ent-{i:032x}", f"ent-{j:032x}"))) for i in range(len(u)) for j in np.argsort(-s[i])[:5] if s[i, j] >= 0.8}
    assert len(got & want) >= 0.97 * len(want) and len(got & want) >= 0.97 * len(got)


def test_a_second_level_of_cells_keeps_recall(spark, monkeypatch):
    """One cell for the whole table: only the second level is left to find neighbours."""
    v = vectors(6000, 5)
    u = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    books = neighbours.codebooks(u[:2000])
    s = u @ u.T
    got = {}
    for rows, places, cos in neighbours.nearest_in_cells(u, u, books, 6):
        got |= {int(r): {int(p) for p, c in zip(ps, cs) if p != r and c >= 0.8} for r, ps, cs in zip(rows, places, cos)}
    np.fill_diagonal(s, -1)
    want = {i: {int(j) for j in np.argsort(-s[i])[:5] if s[i, j] >= 0.8} for i in range(len(u))}
    assert len(u) > neighbours.SPLIT_ROWS and sorted(got) == list(range(len(u)))
    assert sum(len(want[i] & got[i]) for i in want) >= 0.95 * sum(map(len, want.values()))


def test_bad_vectors_copies_and_writes(spark):
    one = [1.0] + [0.0] * 63
    rows = [("a", one, 1), ("b", one, 1), ("c", one, 1), ("c", [0.0] * 64, 2), ("d", [1.0], 1), ("e", None, 1), ("f", [float("nan")] + one[1:], 1), ("g", [None, *one[1:]], 1), ("ü-x", [2.0] + [0.0] * 63, 1), (None, one, 1)]
    df = spark.createDataFrame(rows, "id string, vector array<float>, seq int")
    found = neighbours.neighbours(df, seq=F.col("seq").cast("string"))
    assert sorted((r.id, r.other) for r in found.collect()) == [("a", "b"), ("a", "ü-x"), ("b", "a"), ("b", "ü-x"), ("ü-x", "a"), ("ü-x", "b")]
    assert neighbours.neighbours(df.limit(0)).count() == 0


def test_many_copies_of_one_vector(spark):
    one = [1.0] + [0.0] * 63
    df = spark.createDataFrame([(f"ent-{i:032x}", one) for i in range(500)], "id string, vector array<float>")
    got = neighbours.neighbours(df).collect()
    assert len(got) == 2500 and {r.other for r in got if r.id == f"ent-{400:032x}"} == {f"ent-{i:032x}" for i in range(5)}


def test_anisotropic_codes_keep_scores_better():
    v = vectors(1200, 3).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    books = neighbours.codebooks(v)
    parts = v.reshape(len(v), neighbours.SUBSPACES, -1)

    def along(codes):
        r = parts - books[np.arange(neighbours.SUBSPACES)[None], codes]
        return np.abs((r * parts).sum((1, 2))).mean()

    assert along(neighbours.encode(v, books)) < along(neighbours.encode(v, books, 0))


def test_packing_is_exact_to_a_hundred_thousandth():
    import pyarrow as pa

    v = vectors(50)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    w = neighbours.unpack(pa.array(neighbours.pack(v), pa.binary()))
    assert np.abs((v @ v.T) - (w @ w.T)).max() < 5e-5


# --- 6 scans
def test_trie_against_brute_force():
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 7))) for _ in range(300)]
    trie = scans.Trie(words)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for w in words[:40]:
        for d in (1, 2):
            assert set(trie.within(w, d)) == {x for x in words if plain(w, x) <= d}


def test_furniture():
    for line, header, page in (("- 86 -", False, True), ("12 / 412", False, True), ("[79]", False, True), ("Page 157", False, True), ("p. 130", False, True), ("cxxiv", False, True), ("Annals 0f Nested Filter, Vol. 9", True, False), ("M A R I N E · REPORT", True, False), ("148    Chapter 10. Tidal Settlement", True, True), ("POLAR INDEX QUARTERLY", True, False), ("Somobrurken: Porous ontology kernel    77", True, True), ("In 1998, the team revisited", False, False), ("", False, False), ("| 1990 | 4 |", False, False), ("i", False, False)):
        assert (bool(scans.furniture(line)[0]), scans.furniture(line)[1]) == (header, page), line


def test_headings_that_stand_once_stay():
    """What headings share with running titles needs evidence of the page."""
    text = "One finding is stated here.\n\nSUMMARY OF FINDINGS\n\nIt is long and it goes on.\n\nChapter 3 The Reef System\n\nThe reef grew until\n\n1998\n\nand then it shrank.\n\nResults: Main effects of treatment\n\nThey were small."
    assert [k for _, k, _ in scans.page(text) if k] == ["maybe"] * 3
    assert scans.mend(text, None, None, None) == text
    assert scans.mend(text, [scans.skeleton("SUMMARY OF FINDINGS")], None, None).count("SUMMARY") == 0
    for page in ("the reef grew\nSUMMARY OF FINDINGS\nuntil it shrank.", "It shrank.\n12\nSUMMARY OF FINDINGS\nIt grew.", "It shrank.\n\nSUMMARY OF FINDINGS   12\n\nIt grew.", "SUMMARY OF FINDINGS\nthe reef grew\nuntil it shrank\nand went."):
        assert "SUMMARY" not in scans.mend(page, None, None, None), page
    assert [k for _, k, _ in scans.page("7\n12\n1998")] == [""] * 3 and [k for _, k, _ in scans.page("1998\nIt grew.")] == ["pageno", ""]


def test_tokens_meet_every_word_that_explains_them(spark, rows):
    """Shards by first letter lose no candidate: against all pairs."""
    known = ["measure", "house", "modern", "which", "clear", "dear", "final", "lime", "hire", "uncle", "winter"]
    read = ["rneasure", "bouse", "mocleru", "wliich", "dear", "ciear", "ﬁnal", "1ime", "lire", "nncle", "vvinter", "cat"]
    k = spark.createDataFrame([(w, 1000) for w in known], "word string, n long")
    s = spark.createDataFrame([(w, 1) for w in read], "token string, n long")
    want = {(t, w) for t in read for w in known if t != w and (how := scans.explains(t, w)) and (len(how) == 1 or len(how) <= max(1, len(w) // 4) or any(c in "01!|@5698" for c in t))}
    assert set(rows(scans.candidates(s, k), "token", "word")) == want and ("rneasure", "measure") in want and ("dear", "clear") not in want


def test_the_filter_passes_every_token(spark):
    words = ["wliich", "tlie", "ﬁnal", "日本", "a"]
    passing = scans.token_filter(spark.createDataFrame([(w,) for w in words], "token string"))
    assert all(map(passing, words)) and sum(passing(f"w{i}") for i in range(2000)) < 20
    assert not scans.token_filter(spark.createDataFrame([], "token string"))("a")


def test_words_cut_and_confusions():
    assert [x[:2] for x in scans.joined(["the bench-", "", "mark was"])] == [("bench", "mark")]
    assert scans.explains("tlie", "the") == ("li>h",) and scans.explains("frorn", "from") == ("rn>m",) and scans.explains("cat", "dog") is None
    assert scans.mend("a bench­\nmark here.\nPage 3\nOn", None, None, None) == "a benchmark here. On"
    assert scans.mend(None, None, None, None) is None and scans.mend("  ", None, None, None) == "  " and scans.mend("a\nb", None, None, None) == "a\nb"
    assert scans.mend("Page 3", None, None, None) == ""


def test_kinds(spark, rows):
    plain = "the glacier was measured and the reef was near the glacier"
    data = [(f"c{i}", f"d{i}", plain) for i in range(12)] + [("x", "d", "the glacicr was mea-\nsured"), ("y", "d", "- 3 -\nthe reef"), ("z", "d", None), ("w", "d", ""), ("q", "d", "H2O and CO2 B0")]
    df = spark.createDataFrame(data, "id string, doc string, content string")
    assert rows(scans.kinds(df)) == [("x", "hyphen"), ("x", "misread"), ("y", "pageno")]
    assert {r.id: r.clean for r in scans.repair(df).collect()}["x"] == "the glacier was measured"
    assert scans.kinds(df.limit(0)).count() == 0


def test_misread_at_any_size(spark, rows):
    """The same words in ten times the text are the same misreadings; a word of its own stays one."""
    plain = "the glacier was measured; which of the reefs are near the coast"
    one = [plain] * 120 + ["the glacier was measured; wliich of tlie reefs arc near the coast"] + ["large arc, wide arc, long arc"] * 4
    found = []
    for times in (1, 10, 40):
        data = [(f"c{i}-{k}", f"d{i}-{k}", t) for k in range(times) for i, t in enumerate(one)]
        df = spark.createDataFrame(data, "id string, doc string, content string")
        found.append({r.token for r in scans.corrections(df, scans.vocabulary(df)).collect()})
    assert found == [{"wliich", "tlie"}] * 3


# --- 8 encoding
@pytest.mark.parametrize("text", ["", "plain", "<|endoftext|> x", "日本語 ẞ 👩🏽‍🔬 \u0000 \r\n\t", "a" * 5000, "  \u00a0 "])
def test_round_trip(text):
    ids = encode.encode_batch([text])[0]
    assert encode.decode(ids) == text and 50256 not in ids
    assert [i for i, _, _ in encode.encode_offsets(text)] == ids


def test_encoding_against_the_other_library(spark):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb"))}
    import public_tokenizers

    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["Chunks of text, 1998!", "ﬁnal — “quoted”", None, "", "naïve 𝒳"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in encode.encode(df, "doc_id").collect()}
    assert got == {i: other.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert encode.decode(encode.encode_batch(["é"])[0][:1])


# --- 9 mixture
def test_mixture(spark):
    sized = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 500, "big").when(F.col("id") < 598, "small").alias("source"), F.lit(10).cast("long").alias("n_tokens"))
    targets = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 3)], "source string, target_share double, max_repeats int")
    m = mixture.mixture(sized, targets)
    got = {r.source: r for r in mixture.shares(m, targets).collect()}
    assert abs(got["big"].share - 0.7) < 0.01 and got["small"].most_repeats <= 3 and got["big"].most_repeats == 1
    t = [r.position for r in mixture.ordered(m).collect()]
    assert t == sorted(t) and 0 <= t[0] and t[-1] <= 1
    assert m.groupBy("source", "doc_id", "pass").count().where("count > 1").count() == 0
    early = m.where("position < 0.5").groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()
    share = {r.source: r.n for r in early}
    assert share["big"] / sum(share.values()) > 0.7  # small sources with high caps come late
    assert mixture.mixture(sized.where("source = 'big'"), targets).count() == 0
    assert mixture.mixture(sized.limit(0), targets).count() == 0


def test_given_schedules(spark):
    sized = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1000, "a").otherwise("b").alias("source"), F.lit(10).cast("long").alias("n_tokens"))
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    half = lambda m: {r.source: r.n for r in m.where("position < 0.5").groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    flat, given = half(mixture.mixture(sized, targets)), spark.createDataFrame([("a", 0.9, 0.1), ("b", 0.1, 0.9)], "source string, start_share double, end_share double")
    tilted = half(mixture.mixture(sized, targets, given=given))
    assert abs(flat["a"] - flat["b"]) < 200 and abs(tilted["a"] / (tilted["a"] + tilted["b"]) - 0.7) < 0.02


def test_times_invert_the_schedule(spark):
    t = spark.range(11).select((F.col("id") / 10).alias("s"), F.lit(0.3).alias("k"))
    for r in t.select("s", mixture.time_of(F.col("s"), F.col("k")).alias("t")).collect():
        assert abs(r.t + 0.3 * (r.t * r.t - r.t) - r.s) < 1e-9


# --- 10 personal details
@pytest.mark.parametrize("text,kind,item", [
    ("mail a_b+c@mail.dom.example now", "email", "abcmaildomexample"), ("x [at] mail [dot] d [dot] test", "email", "xatmaildotddottest"), ("jo AT d DOT test", "email", "joatddottest"),
    ("Call +44 7700 900510 12 times", "phone", "447700900510"), ("Tel. 030/23125-553", "phone", "03023125553"), ("01.99.00.09.49", "phone", "0199000949"), ("(555) 555-0134", "phone", "5555550134"),
    ("Passport no. 760116-4679 was", "idnum", "7601164679"), ("DNI 05019860-M", "idnum", "05019860m"),
    ("to 21 rue des Tilleuls, 69157 Trodedanan.", "address", "21ruedestilleuls69157trodedanan"), ("Flat 3, 233 Saltpan Way\nHefezuris HE14 5QX", "address", "flat3233saltpanwayhefezurishe145qx"), ("Erlenweg 170, 29426 Pevubroran", "address", "erlenweg17029426pevubroran"),
    ("Thanks to Dr Zofia K. Stuzuzigis for", "name", "zofiakstuzuzigis"), ("R. K. Savibrusor left", "name", "rksavibrusor"), ("Huvetrerkis, Hettie", "name", "huvetrerkishettie"),
])
def test_details(text, kind, item):
    found = [(k, personal.item(text[a:b])) for k, a, b in personal.find(text)]
    assert found == [(kind, item)]
    assert f"[{kind.upper()}]" in personal.redact(text)


@pytest.mark.parametrize("text,kind,whole", [
    ("We met Zbigniew Wójcik there", "name", "Zbigniew Wójcik"), ("Contact: Łukasz Šimek, Prague", "name", "Łukasz Šimek"), ("seen with Nguyen Van Anh today", "name", "Nguyen Van Anh"), ("Author: Bjarne Stroustrup.", "name", "Bjarne Stroustrup"),
    ("Interviewed Chinedu Okafor on", "name", "Chinedu Okafor"), ("Dear Αλέξανδρος Παπαδόπουλος,", "name", "Αλέξανδρος Παπαδόπουλος"), ("Speaker was Dr Ishaan Vibestobis.", "name", "Ishaan Vibestobis"), ("Regards,\nOkafor, Chinedu\n", "name", "Okafor, Chinedu"),
    ("IBAN DE89 3704 0044 0532 0130 00 is", "account", "DE89 3704 0044 0532 0130 00"), ("card 4111 1111 1111 1111 ok", "account", "4111 1111 1111 1111"), ("mail jörg@müller.de now", "email", "jörg@müller.de"), ("联系abc@d.com吧", "email", "abc@d.com"),
    ("at 12 Kensington Church Street, Royal Tunbridge, London W8 4LX now", "address", "12 Kensington Church Street, Royal Tunbridge, London W8 4LX"),
    ("Flat 3, 233 " + "Saltpanwayofthewest" * 6 + " Northumberlandshire Way\n" + "H" + "efezuris" * 15 + " HE14 5QX", "address", "Flat 3, 233 " + "Saltpanwayofthewest" * 6 + " Northumberlandshire Way\n" + "H" + "efezuris" * 15 + " HE14 5QX"),
])
def test_details_beyond_lists_and_windows(text, kind, whole):
    assert [(k, text[a:b]) for k, a, b in personal.find(text)] == [(kind, whole)]


@pytest.mark.parametrize("text", ["card 4111 1111 1111 1112 ok", "Thanks to North Sea Survey", "Contact: Marine Office", "Interviewed Staff of", "the Wójcik test", "From: The Museum"])
def test_no_accounts_and_bodies(text):
    assert not [x for x in personal.find(text) if x[0] in ("account", "name")]


@pytest.mark.parametrize("text", [None, "", " ", "release 3.12.64", "sample 8841-62-02", "user@ is left out", "see @section-14", "ratio 555:16", "pp. 123-145", "ISBN 978-0-0000-1700-1", "grant 40-221-7765", "the Pinohutan test", "doi 10.99991/aquifer.1964.0025", "In 1998 we met"])
def test_no_details(text):
    assert personal.find(text) == [] and personal.redact(text) == text


def test_details_table(spark):
    df = spark.createDataFrame([(1, "a@b.example and a@b.example", "x"), (2, None, "y")], "doc_id int, text string, details2 string")
    got = {r.doc_id: r for r in personal.scan(df).collect()}
    assert [(x.kind, x.item) for x in got[1].details] == [("email", "abexample")] and got[1].clean == "[EMAIL] and [EMAIL]" and got[2].clean is None
