"""Mixing sources to target weights, by weighted sampling without replacement.

Each source has a budget of words.  Complete epochs (every document once)
come first; what is left of the budget is a fraction of an epoch, chosen by
Efraimidis and Spirakis' method: a document gets the exponential key
-ln(u) / weight, with u from a hash of its id, and the documents with the
smallest keys are taken until their sizes reach the rest of the budget.

The cut is a (key, id) pair per source, found without sorting a source in
one task: sizes are summed over 2^10 ranges of the key, then over 2^10
ranges within the one that holds the cut, and only the rows of that last
range are prefix-summed.  Every source, hot or not, costs three map-side
combined sums.  All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.llm.components import written

RANGE_BITS = 10
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(id_col: str, seed: str) -> Column:
    """A number in (0, 1) from the id alone, the same on every run and in
    every engine that has md5."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def exponential_key(id_col: str, weight: Column, seed: str) -> Column:
    """-ln(u) / weight; a null, NaN or non-positive weight sorts last."""
    good = weight.isNotNull() & ~F.isnan(weight) & (weight > 0)
    return F.when(good, -F.log(uniform(id_col, seed)) / weight).otherwise(F.lit(float("inf")))


def _range(key: Column) -> Column:
    """Monotone in the key: 0 to 2^20 - 1."""
    top = (1 << 2 * RANGE_BITS) - 1
    x = F.when(key < 1e15, F.floor(key / (key + 1) * (top + 1))).otherwise(F.lit(top))
    return F.least(x, F.lit(top)).cast("long")


def source_targets(sizes: DataFrame, source_col: str, max_epochs: int = 3) -> DataFrame:
    """Budgets from (source, source_size): sources by code point, nulls last,
    weigh 1, 2, 3, repeating, and share the sum of all sizes; a target stops
    at ``max_epochs`` times its source's size and the excess goes to the
    others by weight.  The table has a row per source."""
    by_name = Window.orderBy(F.col(source_col).asc_nulls_last())
    big = "decimal(38,0)"
    t = sizes.withColumn("w", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    t = t.withColumn("cap", F.col("source_size") * max_epochs)
    # water-filling: in the order of cap / weight, a source is capped while its
    # cap is below its share of what the ones before it left
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col(source_col).asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left_over"),
        F.sum("w").over(after).alias("w_left"),
    )
    open_ = F.col("cap").cast(big) * F.col("w_left") > F.col("w").cast(big) * F.col("left_over")
    level = F.first(F.when(open_, F.struct("left_over", "w_left")), ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, 0))
    t = t.withColumn("level", level)
    share = (F.col("w").cast(big) * F.col("level.left_over")).cast("double") / F.col("level.w_left").cast("double")
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(share)
    return t.select(source_col, "source_size", target.alias("target"))


def cuts(slim: DataFrame, targets: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """Per source: source_size, target, epochs and the last (key, id) that
    the fraction takes (null: none).

    ``slim`` has id, source, size and key; the document on the edge is taken
    when that brings the sum closer to the target.
    """
    plan = (
        targets.withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    need = plan.filter("rest > 0").select(F.col(source_col).alias("s"), "rest")
    rows = slim.filter("size > 0").withColumn("r", _range(F.col("key")))

    def step(part: DataFrame, cell: Column) -> DataFrame:
        """Running sums over a source's cells, with its rest."""
        sums = part.groupBy(F.col(source_col).alias("g"), cell.alias("cell")).agg(F.sum("size").alias("size"))
        up = Window.partitionBy("g").orderBy("cell")
        total = sums.withColumn("cum", F.sum("size").over(up))  # at most 2^10 rows a source
        return total.join(need, F.col("g").eqNullSafe(F.col("s")))

    fine = 1 << RANGE_BITS
    lowest = lambda sums: (  # noqa: E731  the first cell that reaches the rest, and the sum before it
        sums.groupBy("s").agg(F.min(F.struct("cell", (F.col("cum") - F.col("size")).alias("before"))).alias("c")).select("s", "c.*")
    )
    coarse = F.floor(F.col("r") / fine)
    c1 = lowest(step(rows, coarse).filter("cum >= rest")).withColumnsRenamed({"s": "s1", "cell": "cell1", "before": "before1"})
    inner = rows.join(c1.drop("before1"), F.col(source_col).eqNullSafe(F.col("s1")) & (coarse == F.col("cell1"))).drop("s1", "cell1")
    sums = step(inner, F.col("r")).join(c1.select("s1", "before1"), F.col("s").eqNullSafe(F.col("s1")))
    c2 = lowest(sums.withColumn("cum", F.col("before1") + F.col("cum")).filter("cum >= rest"))
    last = (
        rows.join(c2, F.col(source_col).eqNullSafe(F.col("s")) & (F.col("r") == F.col("cell")))
        .groupBy("s", "before", "key", F.col(id_col).alias("id"))
        .agg(F.sum("size").alias("size"))
    )
    up = Window.partitionBy("s").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)
    edge = last.withColumn("cum", F.col("before") + F.sum("size").over(up)).join(
        need.withColumnRenamed("s", "s2"), F.col("s").eqNullSafe(F.col("s2")))
    taken = edge.filter("2 * cum - size < 2 * rest").groupBy("s").agg(F.max(F.struct("key", "id")).alias("cut"))
    # no row of the edge range taken: all ranges below it are
    both = c2.join(taken.withColumnRenamed("s", "s3"), F.col("s").eqNullSafe(F.col("s3")), "left")
    found = both.select("s", F.col("cell").alias("cut_range"), "cut")
    return plan.join(found, F.col(source_col).eqNullSafe(F.col("s")), "left").drop("s", "rest")


def mix(
    docs: DataFrame,
    size: Column,
    weight: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    targets: DataFrame | None = None,
    seed: str = "mix",
    max_epochs: int = 3,
) -> DataFrame:
    """Every row with ``source_size``, ``target`` and ``copies``, how often
    the mix takes it.

    ``targets`` may name budgets (source, target); by default
    ``source_targets``.  Rows of size 0 (null or empty texts) are taken with
    the complete epochs, which costs nothing.  Null sources are a source.
    Rows that share an id are taken or left together.  A row's columns of the
    added names are replaced.
    """
    added = ("source_size", "target", "copies")
    base = docs.drop(*added, "_size", "_key").withColumns({"_size": size, "_key": exponential_key(id_col, weight, seed)})
    slim = written(base.select(id_col, source_col, F.col("_size").alias("size"), F.col("_key").alias("key")), "mix-sizes")
    return _taken(base, slim, id_col, source_col, targets, max_epochs).drop("_size", "_key")


def mix_sizes(docs: DataFrame, size: Column, weight: Column, id_col: str = "doc_id", source_col: str = "source",
              targets: DataFrame | None = None, seed: str = "mix", max_epochs: int = 3) -> DataFrame:
    """As ``mix`` for (id, source, size) rows alone: the texts are read once."""
    keyed = docs.select(id_col, source_col, size.alias("size"), exponential_key(id_col, weight, seed).alias("key"))
    slim = written(keyed, "mix-sizes")
    base = slim.withColumnsRenamed({"size": "_size", "key": "_key"})
    return _taken(base, slim, id_col, source_col, targets, max_epochs).withColumnRenamed("_size", "size").drop("_key")


def _taken(base: DataFrame, slim: DataFrame, id_col: str, source_col: str, targets: DataFrame | None, max_epochs: int) -> DataFrame:
    sizes = slim.groupBy(source_col).agg(F.sum("size").alias("source_size"))
    if targets is None:
        plan = source_targets(sizes, source_col, max_epochs)
    else:
        given = targets.select(F.col(source_col).alias("_s"), "target")
        plan = sizes.join(given, F.col(source_col).eqNullSafe(F.col("_s")), "left").drop("_s").withColumn(
            "target", F.least(F.coalesce("target", F.lit(0.0)), F.col("source_size") * float(max_epochs)))
    table = written(cuts(slim, plan, id_col, source_col), "mix-cuts").withColumnRenamed(source_col, "_s")
    out = base.join(table, F.col(source_col).eqNullSafe(F.col("_s")), "left")
    r = _range(F.col("_key"))
    at_edge = F.struct(F.col("_key").alias("key"), F.col(id_col).alias("id")) <= F.col("cut")
    fraction = F.coalesce((r < F.col("cut_range")) | ((r == F.col("cut_range")) & at_edge), F.lit(False))
    return out.withColumn("copies", F.coalesce(F.col("epochs"), F.lit(0)) + fraction.cast("long")).drop("_s", "epochs", "cut_range", "cut")
