"""Stores, mailbox and streams."""

import datetime as dt

import pytest

from graphloom.sources import stores
from graphloom.streaming import ingest as ing

T = dt.datetime


def test_only_touched_buckets_are_written(spark, tmp_path, rows):
    t = stores.VersionedTable(spark, str(tmp_path / "t"), "id string, x int, seq long", buckets=8)
    t.upsert(spark.createDataFrame([(f"k{i}", i, 1) for i in range(50)], t.schema), "id", "seq")
    before = t._manifest(1)
    t.upsert(spark.createDataFrame([("k7", 70, 2)], t.schema), "id", "seq")
    after = t._manifest(2)
    assert sum(before[b] != after[b] for b in after) == 1 and t.read().count() == 50 and t.read(1).where("id = 'k7'").first().x == 7
    assert t.vacuum(1) == 0 or t.read().where("id = 'k7'").first().x == 70
    assert t.upsert(spark.createDataFrame([], t.schema), "id", "seq") == 2


def test_of_two_writers_one_wins(spark, tmp_path):
    t = stores.VersionedTable(spark, str(tmp_path / "t"), "id string, x int, seq long", buckets=4)
    at = t.version()
    t.write(spark.createDataFrame([("a", 1, 1)], t.schema), at)
    with pytest.raises(stores.Conflict):
        t.write(spark.createDataFrame([("b", 1, 1)], t.schema), at)
    assert [r.id for r in t.read().collect()] == ["a"]
    # an upsert that loses the race is done again on the winner's version
    real, lost = t.commit, []

    def commit(buckets, expected):
        if not lost:
            lost.append(1)
            other = stores.VersionedTable(spark, str(tmp_path / "t"), t.schema, buckets=4)
            other.upsert(spark.createDataFrame([("c", 3, 1)], t.schema), "id", "seq")
        return real(buckets, expected)

    t.commit = commit
    t.upsert(spark.createDataFrame([("d", 4, 1)], t.schema), "id", "seq")
    assert sorted(r.id for r in t.read().collect()) == ["a", "c", "d"]


def test_leases(spark, tmp_path):
    a, b = (stores.Lease(spark, str(tmp_path), who, 10) for who in "ab")
    assert a.acquire("k", 0.0) and not b.acquire("k", 5.0) and a.acquire("k", 6.0) and not b.acquire("k", 12.0) and b.acquire("k", 17.0) and not a.acquire("k", 18.0)
    b.release("k")
    assert a.acquire("k", 19.0) and b.acquire("other", 19.0)


def test_vectors_are_found_after_the_flush(spark, tmp_path):
    s = stores.VectorSink(spark, str(tmp_path), "m", 2, 4)
    s.add(spark.createDataFrame([("a", [1.0, 0.0], "{}", 1), ("b", None, "{}", 1)], s.SCHEMA))
    assert s.search([1.0, 0.0], 5).count() == 0 and s.pending() == 2
    s.flush()
    assert [r.id for r in s.search([1.0, 0.0], 5).collect()] == ["a"] and s.pending() == 0 and s.flush() == 1
    with pytest.raises(ValueError):
        stores.VectorSink(spark, str(tmp_path), "m", 3)
    with pytest.raises(Exception, match="2 values"):
        s.add(spark.createDataFrame([("c", [1.0], "{}", 1)], s.SCHEMA))


def test_three_channels(spark, tmp_path, rows):
    box = ing.Mailbox(spark, str(tmp_path / "box"))
    work = ing.Ingest(spark, str(tmp_path / "out"), 100, 10, 4)
    put = lambda channel, *m: box.put(channel, spark.createDataFrame(m, ing.MESSAGE))
    drain = lambda: work.run(box.stream(), str(tmp_path / "cp")).awaitTermination(120)
    put("documents", ("a", "reef " * 50, T(2024, 1, 1)), ("b", "reef " * 50, T(2024, 1, 2)), ("c", " ", T(2024, 1, 1)), ("d", "old", T(2024, 1, 1)), (None, "x", None))
    drain()
    assert rows(work.docs.read(), "id", "state") == [("a", "processed"), ("c", "failed"), ("d", "processed")]
    assert rows(work.copies.read(), "id", "original") == [("b", "a")]
    put("retries", ("c", "now a text", T(2024, 1, 3)), ("d", "not asked", T(2024, 1, 3)))
    put("rescans", ("a", "short", T(2024, 1, 3)))
    drain()
    assert rows(work.docs.read(), "id", "content", "state") == [("a", "short", "processed"), ("c", "now a text", "processed"), ("d", "old", "processed")]
    assert [r.content for r in work.chunks.read().where("doc_id = 'a'").collect()] == ["short"]
    with pytest.raises(ValueError):
        put("other", ("a", "b", None))


def test_windows_sessions_and_joins_of_streams(spark, tmp_path):
    schema = "user string, kind string, ts timestamp"
    at = lambda m: T(2024, 1, 1, 12) + dt.timedelta(minutes=m)
    data = [("u", "click", at(0)), ("u", "error", at(3)), ("u", "click", at(20)), ("v", "error", at(4)), ("u", "click", at(200)), ("v", "click", at(300))]
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "in"))

    def run(df, name, mode="append"):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        assert q.awaitTermination(120) is not False
        return spark.table(name)

    stream = lambda: ing.source(spark, str(tmp_path / "in"), schema)
    got = run(ing.windowed_counts(stream(), "ts", "kind", "10 minutes", "1 minute", "5 minutes"), "sliding", "complete")
    assert got.where("kind = 'click'").agg({"n": "sum"}).first()[0] == 8
    assert {(r.user, r.n) for r in run(ing.session_counts(stream(), "ts", "user", "30 minutes", "1 minute"), "sessions").collect()} >= {("u", 3), ("v", 1)}
    both = ing.joined(stream().where("kind = 'click'"), stream().where("kind = 'error'"), "user", "ts", "5 MINUTES")
    assert [(r.user, r.ts, r.ts_r) for r in run(both, "pairs").collect()] == [("u", at(0), at(3))]
