"""Mixing sources to target weights along a time-varying curriculum (operator 10).

Sources, by code point with null last, weigh 5, 2, 1, 5, 2, 1, ... and share the total size
of all documents; a target stops at ``max_repeats`` times its source's size and the excess
goes to the others by weight (a water level, found in closed form from a sorted prefix sum
over the sources).

Curriculum: at training time u in [0, 1] source i is drawn at the rate
``target_i (1 + a_i (2u - 1))``, with ``a_i`` from ``slopes`` by the source's place. The
integral of this schedule, ``D_i(u) = target_i (u + a_i (u^2 - u))``, is the source's demand:
the words that it has given by time u.

A source gives its documents whole, in hash order, over and over (``max_repeats`` times at
most), so that the middle of each copy lies at a fixed word of what the source gives. The
copy's position is the time at which the demand reaches that word, ``D_i`` inverted: the root
of a quadratic. A copy whose word the demand does not reach by time 1 is not taken. So the
positions say how often a document is taken, and a source's taken words differ from its
target by half a document at most.

Training order is the range sort by position: ``mix`` returns its documents in the order of
their first copies (those not taken last), ``training_order`` one row per copy.

Prefix sums never put a source into one task: a source is cut into hash slices, slices are
summed first, and a window runs inside a slice only; the number of slices follows the rows.

Defined cases: null text has size 0; a source or a table of size 0 has target 0 and takes
nothing; a null source is a source of its own, the last. Repeated rows are rows of their
own. Equal hashes are ordered by doc_id. Extra columns are ignored by ``mix`` and kept by
``training_order``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crashlens.llm.common import parallelism, words

WEIGHTS = (5.0, 2.0, 1.0)
SLOPES = (0.0, 0.6, -0.6, 0.3, -0.3)
MAX_REPEATS = 3


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES,
                   max_repeats: float = MAX_REPEATS) -> DataFrame:
    """One row per source: source_size, target, slope. The windows run over the table of
    sources (one row each), never over documents."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "place").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    pick = lambda xs, k: F.element_at(F.array(*[F.lit(x) for x in xs]), (k % len(xs) + 1).cast("int"))
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("place", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", pick(weights, F.col("place"))).withColumn("slope", pick(slopes, F.col("place")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    s = s.withColumn("total", F.sum("source_size").over(every).cast("double")).withColumn("all_weight", F.sum("weight").over(every))
    # Sources in the order in which they fill up; the level if those before are full.
    s = s.withColumn("full", F.coalesce(F.sum("cap").over(by_level), F.lit(0.0)))
    s = s.withColumn("level", (F.col("total") - F.col("full")) / (F.col("all_weight") - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))))
    # The first source in that order that doesn't fill up settles the level for it and all after it.
    opens = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))
    s = s.withColumn("water", F.min(opens).over(every)["level"])
    return s.select("source", "source_size", "slope", F.least(F.col("cap"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap"))).alias("target"))


def _placed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES,
            max_repeats: float = MAX_REPEATS) -> DataFrame:
    """The rows of ``mix``, not yet in order."""
    spark = docs.sparkSession
    slices = 4 * parallelism(spark)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.size(words(F.col("text"))), F.lit(0)).cast("long").alias("size"),
    ).withColumn("size", F.greatest("size", F.lit(0).cast("long")))
    rows = rows.withColumn("h", F.md5(F.concat(F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    # The first digits of the hash cut a source into ordered slices.
    rows = rows.withColumn("slice", F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.lit(slices) / F.lit(2.0**32)).cast("int"))
    per_slice = rows.groupBy("source", "slice").agg(F.sum("size").alias("size"))
    targets = source_targets(per_slice, weights, slopes, max_repeats)
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select("source", "slice", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("slice_start"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    table = starts.alias("s").join(targets.alias("t"), same(starts, targets)).select("s.*", "source_size", "target", "slope")
    inside = Window.partitionBy("source", "slice").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    run = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    run, table = run.alias("d"), table.alias("s")
    joined = run.join(table, F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.slice") == F.col("s.slice"))).select(
        "doc_id", "size", F.col("d.source").alias("source"), "source_size", "target", "slope", (F.col("slice_start") + F.col("inside")).alias("before"))
    return (
        joined.withColumn("positions", _positions(max_repeats))
        .withColumn("copies", F.size("positions").cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn("position", F.get("positions", F.lit(0)))
    )


def _positions(max_repeats: float):
    """The times at which a source's demand reaches the middles of a document's copies, one
    after the other; copy k lies a whole source's words after copy k - 1."""
    def time(k):
        word = F.col("before") + F.col("size") / 2.0 + k * F.col("source_size")
        return F.when((F.col("size") > 0) & (word <= F.col("target")), _time(F.least(F.lit(1.0), word / F.col("target")), F.col("slope")))

    return F.filter(F.array(*[time(k) for k in range(int(max_repeats))]).cast("array<double>"), lambda u: u.isNotNull())


def _time(share, slope):
    """The demand inverted: u with u + slope (u^2 - u) = share; the slope lies within (-1, 1)."""
    b = F.lit(1.0) - slope
    root = (F.sqrt(b * b + F.lit(4.0) * slope * share) - b) / (F.lit(2.0) * slope)
    return F.when(slope == 0, share).otherwise(root)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES,
        max_repeats: float = MAX_REPEATS) -> DataFrame:
    """Per document: doc_id, size, source, source_size, target, slope, before (its source's words
    before its first copy), positions (one per copy taken), copies, taken, and position (of the
    first copy). Rows are range-sorted by position, documents that are not taken last."""
    return _placed(docs, weights, slopes, max_repeats).orderBy(F.asc_nulls_last("position"), "doc_id")


def training_order(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix in training order, one row per copy, with the columns of
    ``docs``."""
    m = _placed(docs, **how).select(F.col("doc_id").alias("__id"), F.col("positions").alias("__positions")).where(F.size("__positions") > 0).dropDuplicates(["__id"])
    rows = docs.join(m, docs["doc_id"].cast("long").eqNullSafe(m["__id"]))
    rows = rows.withColumn("__u", F.explode("__positions"))
    return rows.repartitionByRange(parallelism(docs.sparkSession), "__u", "doc_id").sortWithinPartitions("__u", "doc_id").select(*docs.columns)
