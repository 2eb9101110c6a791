"""Mixing sources to target weights, as a curriculum whose weights change over the training run.

Source s has a weight schedule w_s(t) for t in [0, 1), linear from ``start`` to ``end`` shares, with mean equal to its target.
The size T of the mixture is the largest for which no source is used more than its cap: the least of cap * tokens / target.
Each source then repeats whole passes over its documents and takes the rest of its demand in an order by hash. The token at
offset c of a source's stream belongs at the time t where the integral of w_s reaches c / T; documents are sorted by that
time with a range partitioning.

Cases: rows of null source, and of sources without a target, are left out; null and empty texts hold no tokens and are left
out too; a source with a positive target and no tokens makes the mixture empty (no size can reach its share); equal texts
under several ids are several documents; ties in time are broken by source, document and pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.prefix import running_total

#: Pieces into which each source's stream is cut for its running sum.
PIECES = 1024
#: How far a source's weight moves over the run: from (1 - TILT) to (1 + TILT) times its target, or the other way.
TILT = 0.3


def schedules(targets: DataFrame, tilt: float = TILT, given: DataFrame | None = None) -> DataFrame:
    """Adds ``slope``: the schedule is target * (1 + slope * (2 t - 1)). ``given`` is a table of schedules (source, start_share, end_share)
    whose means are the targets in proportion; sources that it does not hold are flat. Without it, sources that may be repeated more
    often than the least repeated one (the small ones) come late and the others early, and the slopes are scaled so that the weights
    add up to one at any time; if all may be repeated alike, every schedule is flat."""
    if given is not None:
        mean = (F.col("start_share") + F.col("end_share")) / 2
        slope = F.when(mean > 0, (F.col("end_share") - F.col("start_share")) / (2 * mean))
        # a source's weight is never below 0
        g = given.select("source", F.least(F.greatest(slope, F.lit(-1.0)), F.lit(1.0)).alias("slope"))
        return targets.join(F.broadcast(g), "source", "left").withColumn("slope", F.coalesce("slope", F.lit(0.0)))
    least_repeats = targets.agg(F.min("max_repeats").alias("_least_repeats"))
    # one row
    targets = targets.join(F.broadcast(least_repeats)).withColumn("_is_late", F.col("max_repeats") > F.col("_least_repeats")).drop("_least_repeats")
    late = F.col("_is_late")
    up = targets.agg(F.sum(F.when(late, F.col("target_share")).otherwise(0.0)).alias("_late"), F.sum(F.when(~late, F.col("target_share")).otherwise(0.0)).alias("_early"))
    least = F.least("_late", "_early")
    slope = F.when(least <= 0, 0.0).when(late, tilt * least / F.col("_late")).otherwise(-tilt * least / F.col("_early"))
    # one row; the targets themselves are one row a source
    return targets.join(F.broadcast(up)).withColumn("slope", slope).drop("_late", "_early", "_is_late")


def time_of(share: Column, slope: Column) -> Column:
    """The t at which the integral of 1 + slope * (2 t - 1), that is t + slope * (t^2 - t), reaches ``share``."""
    b = 1 - slope
    return F.when(F.abs(slope) < 1e-12, share).otherwise(2 * share / (b + F.sqrt(F.greatest(b * b + 4 * slope * share, F.lit(0.0)))))


def plan(sized: DataFrame, targets: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """One row a source: tokens there, demand, and the size of the whole mixture."""
    there = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    t = schedules(targets, given=given).join(there, "source", "left").na.fill(0, ["tokens", "docs"])
    bound = F.when(F.col("target_share") > 0, F.col("max_repeats") * F.col("tokens") / F.col("target_share"))
    whole = t.agg(F.coalesce(F.min(bound), F.lit(0.0)).alias("size"))
    return t.join(F.broadcast(whole)).withColumn("demand", F.floor(F.col("size") * F.col("target_share") + F.lit(1e-6)).cast("long"))


def mixture(sized: DataFrame, targets: DataFrame, seed: int = 0, given: DataFrame | None = None) -> DataFrame:
    """source, doc_id, pass, n_tokens, position (0 to 1), one row for each use of a document. ``sized``: doc_id, source,
    n_tokens; ``targets``: source, target_share, max_repeats; ``given``: schedules as in ``schedules``."""
    sized = sized.where("source is not null and n_tokens > 0").select("doc_id", "source", "n_tokens")
    p = plan(sized, targets, given).where("tokens > 0").select("source", "tokens", "demand", "slope", "target_share", "size", "max_repeats")
    spot = F.xxhash64(F.lit(seed), "doc_id")
    piece = F.pmod(F.shiftrightunsigned(spot, 32), F.lit(PIECES))
    placed = running_total(sized.withColumn("_h", spot), ["source"], [F.col("_h"), F.col("doc_id")], F.col("n_tokens"), piece, "offset")
    # the plan is one row a source of mix_targets, a table of fixed size
    placed = placed.drop("_h").join(F.broadcast(p), "source")
    # the use numbered r takes the stream's tokens from r * tokens + offset on; it counts if its middle is within the demand
    middle = F.col("offset") + F.col("n_tokens") / 2
    uses = F.least(F.col("max_repeats").cast("long"), F.ceil((F.col("demand") - middle) / F.col("tokens")).cast("long"))
    used = placed.withColumn("uses", uses).where("uses > 0").withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("uses"))))
    start = (F.col("pass") - 1) * F.col("tokens") + F.col("offset")
    share = F.least(start / F.col("demand"), F.lit(1.0))
    return used.select("source", "doc_id", F.col("pass").cast("int").alias("pass"), "n_tokens", time_of(share, F.col("slope")).alias("position"))


def ordered(mixed: DataFrame) -> DataFrame:
    """The mixture in training order: range partitions by position, sorted within."""
    return mixed.orderBy("position", "source", "doc_id", "pass")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """The shares reached, one row a source of ``targets``."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("uses"), F.max("pass").alias("most_repeats"))
    whole = got.agg(F.sum("tokens").alias("_all"))
    t = targets.join(got, "source", "left").na.fill(0, ["tokens", "uses", "most_repeats"]).join(F.broadcast(whole))
    return t.select("source", "target_share", "max_repeats", "tokens", "uses", "most_repeats", F.coalesce(F.col("tokens") / F.col("_all"), F.lit(0.0)).alias("share"))
