"""Mix sources to target weights by nested hash thresholds.

A document's hash says when its turn comes. What a source's target has beyond whole passes over the source is met by taking every
document up to a threshold hash. The threshold is found from sums of sizes by source and hash bucket: the bucket in which the running
sum meets the target is cut into smaller buckets, again and again, and only its documents are summed for that. Nothing is sorted
or gathered: a task holds a sum per source and bucket that it meets, and at most 4,096 sums of a source meet in one window. Sources are ranked in one task, a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosewell.llm.common import WORD, stored, text_of
from prosewell.operators.joins import lookup
from prosewell.sources.store import cut

HASH_BITS = 60
LEVEL_BITS = 12
MAX_REPEATS = 2
SHARE = 1.5
WEIGHTS = (5, 2, 1)


def word_count(column: str = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def turn(doc_id: Column, text: Column) -> Column:
    """A 60-bit hash: the first 15 hex digits of the MD5 of doc_id as text (null: 'null'), a colon and the MD5 of the text (null: empty).

    Only rows of one id and one text have the same turn; how many of them are taken is told apart by `mixed`.
    """
    name = F.coalesce(doc_id.cast("string"), F.lit("null"))
    whole = F.concat(name, F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, turn) of documents; a null text has size 0, a null source is a source of its own."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count().alias("size"),
        turn(F.col("doc_id"), text_of()).alias("turn"),
    )


def source_totals(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy("source").agg(F.sum("size").alias("source_size"))


def rotating_weights(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds `weight`: the weights over and over, sources by code point, null last. Orders one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    return totals.withColumn("weight", F.get(F.array(*map(F.lit, weights)), place))


def share_out(totals: DataFrame, share: float = SHARE, most: int = MAX_REPEATS) -> DataFrame:
    """Adds `target` to (source, source_size, weight); weights are above 0.

    The sources share `share` times the sum of sizes by weight. A source stops at `most` times its size, and the others share what is
    left, until none is above: target = min(most * size, level * weight). Sources fill up in the order of size / weight,
    so the level follows from running sums over one row per source. It is set by the first source that it does not fill.
    """
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    size, weight = F.col("size"), F.col("weight").cast("double")
    rows = totals.select(*totals.columns, F.col("source_size").cast("double").alias("size"))
    rows = rows.withColumn("ratio", size / weight)
    rows = rows.withColumn("full", F.coalesce(F.sum(size).over(before), F.lit(0.0)))
    rows = rows.withColumn("done", F.coalesce(F.sum(weight).over(before), F.lit(0.0)))
    left = F.lit(share) * F.sum(size).over(everything) - F.lit(float(most)) * F.col("full")
    rows = rows.withColumn("level", left / (F.sum(weight).over(everything) - F.col("done")))
    cap = F.lit(float(most)) * size
    rows = rows.withColumn("open", F.when(F.col("level") * weight <= cap, F.struct("done", "level")))
    level = F.min("open").over(everything)["level"]
    rows = rows.withColumn("target", F.least(cap, F.coalesce(level * weight, cap)))
    return rows.select(*totals.columns, "target")


def _key(source: Column) -> Column:
    """A join key that is never null."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source))


def thresholds(
    sizes: DataFrame, targets: DataFrame, bits: int = HASH_BITS, level_bits: int = LEVEL_BITS
) -> DataFrame:
    """(key, source, source_size, target, passes, threshold, edge, edge_rows) for (source, size, turn) and (source, source_size, target).

    The mix takes each document `passes` times, and once more if its turn is at most the threshold, or if it is among `edge_rows` of the rows
    whose turn is `edge`. In order of their turns that are the documents up to the sum nearest to the target; rows of one turn are of one size.
    An empty table has no sources. A source without words has passes 0 and nothing to take.
    """
    docs = sizes.select(_key(F.col("source")).alias("key"), "size", "turn")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plan = targets.select(
        _key(F.col("source")).alias("key"),
        "source",
        "source_size",
        "target",
        F.coalesce(whole, F.lit(0)).cast("long").alias("passes"),
    )
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    plan = cut(plan.withColumn("rest", rest))
    state = plan.select(
        "key", "rest", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("below"),
        F.lit(-1).cast("long").alias("threshold"), F.lit(None).cast("struct<turn:bigint,rows:bigint>").alias("edge"),
        F.col("rest").__gt__(0).alias("unclear"),
    )
    running = Window.partitionBy("key").orderBy("child")
    for used in range(level_bits, bits + level_bits, level_bits):
        shift = max(bits - used, 0)
        width = min(level_bits, bits - used + level_bits)
        unclear = state.filter("unclear").select("key", "bucket", "below", "rest")
        inside = docs.withColumn("child", F.shiftright("turn", shift))
        inside = inside.withColumn("bucket", F.shiftright("child", width))
        sums = (
            lookup(inside, unclear, ["key", "bucket"])
            .groupBy("key", "child", "below", "rest")
            .agg(
                F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"),
                F.min("turn").alias("first"), F.max("turn").alias("last"),
            )
            .withColumn("end", F.col("below") + F.sum("size").over(running))
            .withColumn("start", F.col("end") - F.col("size"))
        )
        one = F.col("first") == F.col("last")
        meets = (F.col("start") < F.col("rest")) & (F.col("end") > F.col("rest"))
        # Of rows of one turn, as many as bring the sum nearest to the target; of two equally near sums the greater.
        rows = F.floor((F.col("rest") - F.col("start")) * F.col("rows") / F.col("size") + 0.5)
        top = F.shiftleft(F.col("child") + 1, shift) - 1
        found = sums.groupBy("key").agg(
            F.max(F.when(F.col("end") <= F.col("rest"), top)).alias("found"),
            F.max(F.when(meets & one, F.struct(F.col("first").alias("turn"), rows.cast("long").alias("rows")))).alias("at_edge"),
            F.max(F.when(meets & ~one, F.struct("child", "start"))).alias("next"),
        )
        state = cut(
            lookup(state, found, "key", "left").select(
                "key",
                "rest",
                F.coalesce("next.child", "bucket").alias("bucket"),
                F.coalesce("next.start", "below").alias("below"),
                F.greatest("threshold", "found").alias("threshold"),
                F.coalesce("at_edge", "edge").alias("edge"),
                F.col("next").isNotNull().alias("unclear"),
            )
        )
        if state.filter("unclear").isEmpty():
            break
    edge = state.select("key", "threshold", F.col("edge.turn").alias("edge"), F.col("edge.rows").alias("edge_rows"))
    return plan.drop("rest").join(edge, "key")


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    """`rows`, stored, with `_number` from 1 within each key: counted within each task's rows, after what the tasks before have."""
    held = cut(rows).withColumn("_task", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    held = cut(held)
    tasks = held.groupBy(key, "_task").agg(F.count(F.lit(1)).alias("_own"))
    before = Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.withColumn("_before", F.coalesce(F.sum("_own").over(before), F.lit(0))).drop("_own")
    own = F.row_number().over(Window.partitionBy(key, "_task").orderBy("_at"))
    numbered = held.withColumn("_own", own).join(tasks, [key, "_task"])
    return numbered.withColumn("_number", F.col("_before") + F.col("_own")).drop("_task", "_at", "_own", "_before")


def mixed(docs: DataFrame, plan: DataFrame, copies: str = "copies") -> DataFrame:
    """`docs` (source, turn, any other columns) with the number of times the mix takes each row, and its source's plan.

    Rows of the turn at the edge of a source's target, one document and its repeated rows, are counted off; equal rows are told apart by their place alone, so
    reruns give the same rows. An empty table gives an empty one.
    """
    rows = docs.withColumn("key", _key(F.col("source")))
    joined = lookup(rows, plan.drop("source"), "key")
    at_edge = F.coalesce(F.col("turn") == F.col("edge"), F.lit(False))
    edge = _numbered(joined.filter(at_edge), "key")
    inner = joined.filter(~at_edge).withColumn("_again", (F.col("turn") <= F.col("threshold")).cast("long"))
    edge = edge.withColumn("_again", (F.col("_number") <= F.col("edge_rows")).cast("long")).drop("_number")
    both = inner.unionByName(edge).withColumn(copies, F.col("passes") + F.col("_again"))
    return both.drop("key", "passes", "threshold", "edge", "edge_rows", "_again")


def plan_mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Thresholds for (source, size, turn). Read more than once, so `sizes` should be stored."""
    totals = cut(source_totals(sizes))
    return thresholds(sizes, share_out(rotating_weights(totals, weights)))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The rows of `docs` (doc_id, source, text, any other columns), each as often as the mix takes it.

    A null source is a source of its own, null and repeated ids are told apart by their texts, and an empty table gives an empty one.
    """
    sizes = stored(sized(docs).drop("doc_id"), "sizes")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("source").cast("string").alias("source"),
        turn(F.col("doc_id"), text_of()).alias("turn"),
    )
    taken = mixed(rows, plan_mix(sizes, weights)).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
