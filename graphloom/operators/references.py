"""References to records that do not exist.

Keys are dictionary-encoded as integers, range by range (a range is a hash bucket, so every range fits one task and a hot key
is one entry). References become compressed bitmaps per key range, referring field and month; parents become bitmaps per key
range and month of creation. In each range, ``references AND NOT parents that were there before that month`` leaves the bits
that can be orphans or late; only these are decoded and meet their rows again, for the exact comparison of times.

Cases: null keys and keys without the required form are no references; a referring row without ``updated_at`` can be orphaned
but never late; a parent without ``created_at`` counts as always there; repeated references of one row count once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_FORM = r"^doc-[0-9a-f]{32}-chunk-[0-9]+$"
#: Keys in one range of the dictionary, about; the number of ranges follows the number of keys.
RANGE_KEYS = 200_000


def pack(bits: np.ndarray, size: int) -> bytes:
    """A set of positions below ``size`` as a deflated bitmap."""
    flags = np.zeros(size, dtype=bool)
    flags[bits] = True
    return zlib.compress(np.packbits(flags).tobytes(), 1)


def unpack(data: bytes, size: int) -> np.ndarray:
    """The flags of a bitmap."""
    return np.unpackbits(np.frombuffer(zlib.decompress(data), dtype=np.uint8), count=size).astype(bool)


def _range_bitmaps(kind: str):
    """For one key range: the surviving keys of each (tbl, field, month). Both inputs hold distinct keys with their month."""

    schema = pa.schema([("kind", pa.string()), ("tbl", pa.string()), ("field", pa.string()), ("month", pa.int32()), ("ref_key", pa.string())])

    def work(left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in schema.names}
        if not left_rows.num_rows:
            return pa.table(out, schema=schema)
        refs, parents = left_rows.to_pandas(), right_rows.to_pandas()
        codes, keys = pd.factorize(pd.concat([refs["key"], parents["key"]], ignore_index=True))
        size = len(keys)
        refs, parents = refs.assign(code=codes[: len(refs)]), parents.assign(code=codes[len(refs) :])
        born = {int(m): pack(g["code"].to_numpy(), size) for m, g in parents.groupby("month")}
        asked = {k: pack(g["code"].to_numpy(), size) for k, g in refs.groupby(["tbl", "field", "month"])}
        order, there, done = sorted(born), np.zeros(size, dtype=bool), 0
        for tbl, field, month in sorted(asked, key=lambda k: k[2]):
            while done < len(order) and order[done] < month:
                there |= unpack(born[order[done]], size)
                done += 1
            left = np.flatnonzero(unpack(asked[tbl, field, month], size) & ~there)
            out["kind"] += [kind] * len(left)
            out["tbl"] += [tbl] * len(left)
            out["field"] += [field] * len(left)
            out["month"] += [month] * len(left)
            out["ref_key"] += list(keys[left])
        return pa.table(out, schema=schema)

    return work


#: Month of rows whose time is null: after every real one for references (nothing can be late), before for parents.
NEVER, ALWAYS = 2_000_000, -1


def _month(c: str, null: int):
    return F.coalesce((F.year(c) * 12 + F.month(c)).cast("int"), F.lit(null))


def dangling(refs: DataFrame, parents: DataFrame, kind: str, keys: int) -> DataFrame:
    """References without a parent that is there in time.

    refs: tbl, row_key, field, ref_key, updated_at. parents: key, created_at (one row a key). ``keys``: about how many different
    keys both hold together, for the number of ranges. Returns tbl, row_key, field, ref_key, updated_at, exists (whether the parent
    comes later)."""
    ranges = ranges_for(refs.sparkSession, keys)
    refs = refs.withColumn("month", _month("updated_at", NEVER))
    bucket = F.pmod(F.xxhash64("key"), F.lit(ranges))
    asked = refs.select("tbl", "field", "month", F.col("ref_key").alias("key")).distinct().withColumn("bucket", bucket)
    born = parents.select("key", _month("created_at", ALWAYS).alias("month")).withColumn("bucket", bucket)
    left = asked.groupBy("bucket").cogroup(born.groupBy("bucket")).applyInArrow(_range_bitmaps(kind), "kind string, tbl string, field string, month int, ref_key string")
    # the survivors are unique by these keys: the month splits a hot key, and the skew join splits the rest
    again = refs.join(left.drop("kind"), ["tbl", "field", "month", "ref_key"], "left_semi").drop("month")
    seen = again.join(parents.select(F.col("key").alias("ref_key"), F.col("created_at"), F.lit(True).alias("exists")), "ref_key", "left")
    late = F.col("exists") & (F.col("created_at") > F.col("updated_at"))
    return seen.where(F.col("exists").isNull() | late).select("tbl", "row_key", "field", "ref_key", "updated_at", F.coalesce("exists", F.lit(False)).alias("exists"))


def count_keys(*keys: DataFrame) -> int:
    """About how many different keys one-column tables hold, added up: an upper bound for their union, within 5 %."""
    return sum(int(k.agg(F.approx_count_distinct(F.col(k.columns[0]))).first()[0]) for k in keys)


def ranges_for(spark: SparkSession, keys: int) -> int:
    """Ranges of the dictionary for about so many keys, at least one for each shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys // RANGE_KEYS))


def explain_missing(found: DataFrame, deletions: DataFrame, tbl: str, owner) -> DataFrame:
    """Adds reason: late, deleted (``deletions`` lists the owner of the key in ``tbl``) or missing."""
    gone = deletions.where(F.col("tbl") == tbl).select(F.col("record_key").alias("owner"), F.lit(True).alias("gone")).distinct()
    reason = F.when(F.col("exists"), "late").when(F.col("gone"), "deleted").otherwise("missing")
    return found.withColumn("owner", owner).join(gone, "owner", "left").withColumn("reason", reason).drop("owner", "gone", "exists")
