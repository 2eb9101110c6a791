import io
import zipfile

import pytest
from pyspark.sql import functions as F

from graphloom.functions import external
from graphloom.functions.prefix import running_total
from graphloom.sources import files, stores
from graphloom.streaming.ingest import Ingest, deduplicated, source


def docx(*paragraphs):
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = "".join(f'<w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>{t[2:]}</w:t></w:r></w:p>' if t.startswith("# ") else f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>" for t in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{body}</w:body></w:document>")
    return out.getvalue()


def test_files(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(docx("# Reefs", "text of it"))
    (tmp_path / "b.html").write_text("<h2>Top</h2><p>one &amp; two</p><script>x()</script>")
    (tmp_path / "c.pdf").write_bytes(b"%PDF")
    (tmp_path / "d.txt").write_bytes(b"")
    got = {r.path.rsplit("/", 1)[-1]: (r.text, r.error) for r in files.read_texts(spark, str(tmp_path)).collect()}
    assert got["a.docx"][0] == "# Reefs\n\ntext of it"
    assert got["b.html"][0] == "## Top\n\none & two"
    assert got["c.pdf"][0] is None and "extractor" in got["c.pdf"][1]
    assert "d.txt" not in got


def test_blocks_and_tables():
    assert files.markdown_blocks("# A\n\nx\n\n## B\n\n```\n# no\n```") == [(1, "A", [], "x"), (2, "B", ["A"], "```\n# no\n```")]
    assert files.markdown_blocks(None) == []
    assert files.table_rows("<table><tr><th>y<td>1</tr></table>") == [["y", "1"]]
    assert files.table_rows('[["a", 1], [null, 2]]') == [["a", "1"], ["", "2"]] and files.table_rows("x") == []
    assert files.has_header('[["a"], ["1"]]') and not files.has_header(None)


def test_engines(spark):
    d = spark.createDataFrame([("x.docx",), ("x[legacy].docx",), ("x.pdf",), ("x.zzz",), (None,)], "p string")
    assert [r[0] for r in d.select(files.engine(F.col("p"))).collect()] == ["native", "legacy", "legacy", None, None]


def test_broken_block_file_fails(spark, tmp_path):
    p = tmp_path / "blocks.jsonl"
    p.write_text('{"type": "content", "content": "x"}\n{"type": "other"}\n')
    assert files.read_blocks(spark, str(p)).count() == 1
    p.write_text("{broken\n")
    with pytest.raises(Exception):
        files.read_blocks(spark, str(p)).collect()


def test_versions_and_merges(spark, tmp_path, rows):
    t = stores.VersionedTable(spark, str(tmp_path / "t"), "id string, x int, seq long")
    assert t.read().count() == 0
    t.upsert(spark.createDataFrame([("a", 1, 1), ("a", 2, 2), (None, 3, 3)], t.schema), "id", "seq")
    t.upsert(spark.createDataFrame([("a", 0, 1), ("b", 5, 1)], t.schema), "id", "seq")
    assert rows(t.read()) == [("a", 2, 2), ("b", 5, 1)]
    t.delete(spark.createDataFrame([("a",)], "id string"), "id")
    assert rows(t.read()) == [("b", 5, 1)]
    n = "id string, properties map<string,string>, seq long"
    got = stores.upsert_nodes(spark.createDataFrame([("a", {"k": "1", "l": "2"}, 1)], n), spark.createDataFrame([("a", {"k": "3"}, 2)], n)).first()
    assert got.properties == {"k": "3", "l": "2"}
    with pytest.raises(ValueError):
        stores.custom_graph(spark, {"relationships": [{"src_id": "a", "tgt_id": "a"}]})


def test_stream_equals_batch(spark, tmp_path, rows):
    schema = "id string, content string, created_at timestamp"
    data = [(f"d{i}", f"text {i % 3} " * 50, None) for i in range(9)]
    spark.createDataFrame(data, schema).repartition(3).write.parquet(str(tmp_path / "in"))
    ingest = Ingest(spark, str(tmp_path / "out"), 100, 10)
    q = ingest.run(source(spark, str(tmp_path / "in"), schema, files=1), str(tmp_path / "cp"))
    assert q.awaitTermination(120) is not False
    docs = ingest.docs.read()
    assert docs.count() == 3 and docs.select("content_hash").distinct().count() == 3
    before = rows(ingest.chunks.read())
    ingest.batch(docs.select("id", "content", "created_at"), 0)
    assert rows(ingest.chunks.read(), "id") == [(r[0],) for r in before]
    assert deduplicated(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "content").isStreaming


def test_external_functions(spark):
    d = spark.createDataFrame([(1, "reef lichen"), (2, None), (3, "reef lichen")], "id int, content string")
    e = {r.id: r.vector for r in external.embed(d, "content").collect()}
    assert e[1] == e[3] and e[2] is None
    assert [r.rerank_score for r in external.rerank(d.where("id = 1"), "reef", "content").collect()] == [1.0]

    def broken(q, t):
        raise RuntimeError

    assert external.rerank(d.where("id = 1"), "reef", "content", function=broken).first().rerank_score is None
    cache = spark.createDataFrame([("x", 1, "r")], "digest string, pass int, reply string")
    assert external.extract(d.withColumn("id", F.col("id").cast("string")), cache).count() == 2


def test_running_total_over_one_hot_group(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), "id", F.lit(2).alias("n")).unionByName(spark.createDataFrame([(None, 5, 3), (None, 6, 4)], "k string, id long, n int"))
    out = running_total(df, ["k"], [F.col("id")], F.col("n"), F.floor(F.col("id") / 64), "before")
    assert {r.id: r.before for r in out.where("k = 'k'").collect()} == {i: 2 * i for i in range(1000)}
    assert sorted(r.before for r in out.where("k is null").collect()) == [0, 3]


def test_extraction_takes_all(spark):
    """All names of a chunk, and the first pass of a chunk of any length; the bound skips further passes only."""
    words = [f"Name{a}{b}" for a in "abcde" for b in "fghijk"]
    d = spark.createDataFrame([("a", " ".join(words)), ("b", "Glacier " * 2_000), ("c", None)], "id string, content string")
    got = {(r.id, r["pass"]): r.reply for r in external.extract(d, passes=2).collect()}
    assert set(got) == {("a", 1), ("a", 2), ("b", 1)}
    assert got["a", 1].count("(entity<") == 30 and got["a", 1].count("(relation<") == 29 and "Glacier" in got["b", 1]
