"""Tables as stores: key-value rows, the graph and vectors, each a sequence of versions.

Rows lie in buckets by the hash of their key. A version is a small manifest that names, for each bucket, the folder that holds it; an
upsert reads and writes the buckets that its rows touch and no others. The manifest of a version is created once and never
replaced, so of two writers that start from one version one fails and tries again on the other's, readers see whole versions only,
and a lost writer leaves nothing but files that no manifest names. Cases: a store without a version is empty; null keys are
dropped; the last row of a key wins by its sequence.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.operators.lifecycle import upsert
from graphloom.session import cut


class Conflict(RuntimeError):
    """Another writer made the version first."""


class Files:
    """Small files in any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path
        self.fs = self._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str = "") -> list[str]:
        where = self.at(folder)
        return [x.getPath().getName() for x in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def create(self, name: str, text: str) -> bool:
        """Creates a file that is not there yet; False if it is."""
        try:
            out = self.fs.create(self.at(name), False)
        except Exception as e:  # noqa: BLE001 - the file system's own kind of error tells that the file exists
            if "exist" in str(e).lower():
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


class VersionedTable:
    """A Parquet table in buckets with versions: ``path/data/<folder>/_bucket=B`` and ``path/versions/N.json``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "id", buckets: int = 64):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets
        self.files = Files(spark, path)
        self.columns = spark.createDataFrame([], schema).columns

    def version(self) -> int:
        return max((int(n[:-5]) for n in self.files.names("versions") if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def _manifest(self, version: int) -> dict[str, str]:
        return json.loads(self.files.read(f"versions/{version}.json")) if version else {}

    def read(self, version: int | None = None, only: list[int] | None = None) -> DataFrame:
        """The current version, or another one; ``only``: these buckets."""
        v = self.version() if version is None else version
        folders = [f"{self.path}/data/{folder}/_bucket={b}" for b, folder in sorted(self._manifest(v).items()) if only is None or int(b) in only]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _store(self, df: DataFrame) -> dict[str, str]:
        folder = f"f-{uuid.uuid4().hex}"
        df.select(*self.columns).withColumn("_bucket", self._bucket()).repartition(self.buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        return {n.split("=")[1]: folder for n in self.files.names(f"data/{folder}") if n.startswith("_bucket=")}

    def commit(self, buckets: dict[str, str], expected: int) -> int:
        """The version after ``expected``; Conflict if there is one already."""
        if self.version() != expected or not self.files.create(f"versions/{expected + 1}.json", json.dumps(buckets)):
            raise Conflict(f"{self.path} is beyond version {expected}")
        return expected + 1

    def write(self, df: DataFrame, expected: int | None = None) -> int:
        """A new version of nothing but these rows."""
        at = self.version() if expected is None else expected
        return self.commit(self._store(df), at)

    def _change(self, touched: DataFrame, change, tries: int = 5) -> int:
        # bucket numbers: no more than there are buckets
        hit = sorted(r["_bucket"] for r in touched.where(F.col(self.key).isNotNull()).select(self._bucket().alias("_bucket")).distinct().collect())
        for n in range(tries):
            at = self.version()
            if not hit:
                return at
            kept = {b: f for b, f in self._manifest(at).items() if int(b) not in hit}
            try:
                return self.commit({**kept, **self._store(change(self.read(at, hit)))}, at)
            except Conflict:
                if n == tries - 1:
                    raise
        return self.version()

    def upsert(self, rows: DataFrame, key: str, seq: str) -> int:
        """The last row of each key by its sequence; only the buckets of the new rows are read and written."""
        new = rows.select(*self.columns)
        return self._change(new, lambda old: upsert(old, new, key, seq))

    def delete(self, keys: DataFrame, key: str) -> int:
        gone = keys.select(key)
        return self._change(gone.withColumnRenamed(key, self.key), lambda old: old.join(gone, key, "left_anti"))

    def vacuum(self, keep: int = 2) -> int:
        """Removes what the last ``keep`` versions do not name; the number of folders removed."""
        last = self.version()
        named = {f for v in range(max(1, last - keep + 1), last + 1) for f in self._manifest(v).values()}
        gone = [f for f in self.files.names("data") if f not in named]
        for f in gone:
            self.files.remove(f"data/{f}")
        for v in range(1, last - keep + 1):
            self.files.remove(f"versions/{v}.json")
        return len(gone)


class Lease:
    """The right to work on a key for a time: a file that only one can create. One that ran out can be taken over; its owner can renew
    or give it back."""

    def __init__(self, spark: SparkSession, path: str, owner: str, seconds: float = 60.0):
        self.files, self.owner, self.seconds = Files(spark, path), owner, seconds

    def acquire(self, key: str, now: float | None = None) -> bool:
        now = time.time() if now is None else now
        name = f"lease-{uuid.uuid5(uuid.NAMESPACE_OID, key).hex}"
        held = sorted(n for n in self.files.names() if n.startswith(name))
        number = 0
        if held:
            number = int(held[-1].rsplit("-", 1)[1])
            state = json.loads(self.files.read(held[-1]))
            if state["until"] > now and state["owner"] != self.owner:
                return False
        # who creates the next number holds the lease; of several that try, one does
        if not self.files.create(f"{name}-{number + 1:012d}", json.dumps({"owner": self.owner, "until": now + self.seconds})):
            return False
        for n in held:
            self.files.remove(n)
        return True

    def release(self, key: str) -> None:
        name = f"lease-{uuid.uuid5(uuid.NAMESPACE_OID, key).hex}"
        for n in self.files.names():
            if n.startswith(name) and json.loads(self.files.read(n))["owner"] == self.owner:
                self.files.remove(n)


class VectorSink:
    """Vectors (id, vector, record, seq) that are written to a buffer and found once it is flushed."""

    SCHEMA = "id string, vector array<float>, record string, seq long"

    def __init__(self, spark: SparkSession, path: str, model: str, dim: int, buckets: int = 64):
        self.spark, self.dim = spark, dim
        self.table = VersionedTable(spark, f"{path}/table", self.SCHEMA, buckets=buckets)
        self.files = Files(spark, path)
        space = json.loads(self.files.read("space.json")) if "space.json" in self.files.names() else None
        check = check_space(space, model, dim)
        if space is None:
            self.files.create("space.json", json.dumps(check))

    def add(self, rows: DataFrame) -> None:
        """Rows into the buffer. A vector of another length is an error."""
        wrong = F.when(F.col("vector").isNotNull() & (F.size("vector") != self.dim), F.raise_error(F.lit(f"a vector has not {self.dim} values"))).otherwise(F.col("vector"))
        rows.select("id", wrong.alias("vector"), "record", "seq").write.parquet(f"{self.files.path}/buffer/b-{uuid.uuid4().hex}")

    def pending(self) -> int:
        names = self.files.names("buffer")
        return self.spark.read.schema(self.SCHEMA).parquet(*(f"{self.files.path}/buffer/{n}" for n in names)).count() if names else 0

    def flush(self) -> int:
        """All that is buffered now into the table, as one version; the buffer is emptied after that."""
        names = self.files.names("buffer")
        if not names:
            return self.table.version()
        v = self.table.upsert(self.spark.read.schema(self.SCHEMA).parquet(*(f"{self.files.path}/buffer/{n}" for n in names)), "id", "seq")
        for n in names:
            self.files.remove(f"buffer/{n}")
        return v

    def search(self, query: list[float], k: int, threshold: float = 0.2) -> DataFrame:
        from graphloom.operators.retrieval import search

        return search(self.table.read().where("vector is not null"), query, k, threshold)


class NoStore:
    """A store that keeps nothing."""

    def __init__(self, spark: SparkSession, schema: str = "id string, score double"):
        self.spark, self.schema = spark, schema

    def read(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame) -> int:
        return 0

    @property
    def is_empty(self) -> bool:
        return True


def upsert_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes (id, properties map, seq) merged key by key: for each property the last value wins."""
    rows = old.unionByName(new).where("id is not null").select("id", "seq", F.explode_outer("properties").alias("k", "v"))
    last = rows.groupBy("id", "k").agg(F.max_by("v", "seq").alias("v"), F.max("seq").alias("seq"))
    entries = F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "v")))
    return last.groupBy("id").agg(F.map_from_entries(F.array_sort(entries)).alias("properties"), F.max("seq").alias("seq"))


def upsert_edges(nodes: DataFrame, old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b, weight, seq) replaced by the last row of each pair; ends without a node become nodes."""
    both = old.unionByName(new).where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "weight", "seq")
    edges = both.groupBy("a", "b").agg(F.max_by("weight", "seq").alias("weight"), F.max("seq").alias("seq"))
    ends = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(nodes.select("id"), "id", "left_anti")
    return nodes.select("id").unionByName(ends), edges


def custom_graph(spark: SparkSession, kg: dict) -> dict[str, DataFrame]:
    """A user's chunks, entities and relationships as tables; relations of a name with itself and weights not above 0 are refused."""
    for r in kg.get("relationships", ()):
        if r["src_id"] == r["tgt_id"]:
            raise ValueError(f"a relation of {r['src_id']!r} with itself")
        if float(r.get("weight", 1.0)) <= 0:
            raise ValueError("a weight must be above 0")
    rows = lambda name, *cols: [tuple(x.get(c) for c in cols) for x in kg.get(name, ())]
    chunks = spark.createDataFrame(rows("chunks", "content", "source_id"), "content string, source_id string")
    entities = spark.createDataFrame(rows("entities", "entity_name", "entity_type", "description", "source_id"), "name string, type string, description string, source_id string")
    relations = spark.createDataFrame([(x["src_id"], x["tgt_id"], float(x.get("weight", 1.0)), x.get("keywords"), x.get("source_id")) for x in kg.get("relationships", ())], "src string, tgt string, weight double, keywords string, source_id string")
    return {"chunks": chunks, "entities": entities, "relations": relations}


def checked_relations(relations: DataFrame) -> DataFrame:
    """Relations (src, tgt, weight, ...) of a user's graph with refused: null ends, a relation with itself, or a weight not above 0 (a missing
    weight is 1); null where it is fine."""
    refused = F.when(F.col("src").isNull() | F.col("tgt").isNull(), "end missing").when(F.col("src") == F.col("tgt"), "self-loop").when(F.coalesce("weight", F.lit(1.0)) <= 0, "weight")
    return relations.withColumn("weight", F.coalesce("weight", F.lit(1.0))).withColumn("refused", refused)


def check_space(stored: dict | None, model: str, dim: int) -> dict:
    """The vector space of a store: refused if it was written by another model or with another length; recorded if it is new."""
    wanted = {"embedding.model": model, "embedding.dim": dim}
    for key, value in wanted.items():
        if stored and key in stored and stored[key] != value:
            raise ValueError(f"{key} is {stored[key]!r} in the store and {value!r} in the session")
    return {**(stored or {}), **wanted}


def counted(df: DataFrame, name: str, **metrics):
    """The table with metrics gathered while it is computed: (df, observation). Metrics are aggregate columns by name."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in metrics.items())), seen


def paged(df: DataFrame, key: str, size: int) -> DataFrame:
    """(page, rows, first, last) of all rows of a table by unique keys in order, ``size`` a page. Keys are range-partitioned and counted a
    partition, so that pages are numbered without sorting the table in one task; ``page_rows`` reads one."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = cut(df.select(key).repartitionByRange(parts, key).sortWithinPartitions(key).withColumn("_part", F.spark_partition_id()))
    counts = ordered.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row a partition
    before = counts.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    placed = ordered.join(F.broadcast(before), "_part").withColumn("page", F.floor((F.col("_before") + number) / size))
    return placed.groupBy("page").agg(F.count("*").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last"))


def page_rows(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """The page after a key (None: the first)."""
    return (df if after is None else df.where(F.col(key) > after)).orderBy(key).limit(size)


def scan(df: DataFrame, key: str, size: int):
    """All rows page by page, as lists of rows; the driver holds one page."""
    after = None
    while rows := page_rows(df, key, after, size).collect():
        yield rows
        after = rows[-1][key]
