"""Mix sources to target weights by weighted fair queueing.

Every document has a place in its source's shuffled order; sources are served in proportion to
their weights, so the virtual finish time of a document is the tokens of its source up to and
including it, divided by the weight of the source. A source may be read up to `passes` times,
one after the other. All (document, pass) rows are range-sorted by finish time and taken until
the budget is used up. A source that runs out frees its share for the others, which is the
re-sharing of the excess.

Running totals are computed in two steps (totals per bucket, then within buckets), so neither a
hot source nor the global order is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import SPACE, materialised, prefix_sums

#: Buckets of the shuffled order of a source, by the first hexadecimal digits of the key.
DIGITS = 3


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """source, source_size -> with `weight`: the cycle over sources by code point, null last.

    Ranks come from a range sort: counts per partition first, then places within partitions.
    """
    # UTF-8 bytes sort as code points do.
    order = [F.col("source").isNull(), F.col("source").cast("binary")]
    tasks = max(1, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = sources.repartitionByRange(tasks, *order).withColumn("task", F.spark_partition_id())
    placed = materialised(placed, "mixing-sources")
    before = prefix_sums(
        placed.groupBy("task").agg(F.count("*").alias("n")), [], "task", "n", "before"
    ).drop("n")
    within = F.row_number().over(Window.partitionBy("task").orderBy(*order))
    at = ((F.col("before") + within - 1) % len(cycle)).cast("int")
    return (
        placed.join(before, "task")
        .withColumn("weight", F.get(F.array(*map(F.lit, cycle)), at).cast("double"))
        .select("source", "source_size", "weight")
    )


def with_targets(sources: DataFrame, budget: int | None = None, passes: int = 3) -> DataFrame:
    """source, source_size, weight -> with `target`: shares of the budget, at most `passes` sizes.

    The level v at which the sum of min(passes * size, weight * v) reaches the budget: sources
    whose cap lies below their share are full, the others share the rest by weight. Levels are
    sorted by range like the weights.
    """
    tasks = max(1, int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    full_at = F.when(F.col("weight") > 0, passes * F.col("source_size") / F.col("weight"))
    placed = (
        sources.withColumn("level", F.coalesce(full_at, F.lit(float("inf"))))
        .repartitionByRange(tasks, "level")
        .withColumn("task", F.spark_partition_id())
    )
    placed = materialised(placed, "mixing-levels")
    whole = placed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = (whole.size or 0) if budget is None else budget
    per_task = placed.groupBy("task").agg(
        F.sum("source_size").alias("size"), F.sum("weight").alias("task_weight")
    )
    w = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.select(
        "task",
        F.coalesce(F.sum("size").over(w), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("task_weight").over(w), F.lit(0.0)).alias("weight_before"),
    )
    w = Window.partitionBy("task").orderBy("level").rangeBetween(Window.unboundedPreceding, 0)
    size_upto = F.col("size_before") + F.sum("source_size").over(w)
    weight_after = (whole.weight or 0.0) - F.col("weight_before") - F.sum("weight").over(w)
    # A source is full if, with all up to its level full, the rest still reaches that level.
    full = (F.col("level") == 0) | (budget - passes * size_upto >= F.col("level") * weight_after)
    summed = placed.join(per_task, "task").withColumn("full", full & (F.col("weight") > 0))
    summed = materialised(summed, "mixing-full")
    given, weight = summed.agg(
        F.sum(F.when(F.col("full"), passes * F.col("source_size")).otherwise(0)),
        F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)),
    ).first()
    cap = (passes * F.col("source_size")).cast("double")
    share = F.lit(budget - (given or 0)).cast("double") * F.col("weight") / F.lit(weight or 1.0)
    target = F.when(F.col("full"), cap).otherwise(F.least(cap, share))
    return summed.select("source", "source_size", "weight", target.alias("target"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """docs with `mix`: the source, the place in the shuffled order, the size in words."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), text))
    source = F.col(source_col).cast("string")
    return docs.withColumn(
        "mix", F.struct(source.alias("source"), key.alias("key"), words(text_col).alias("size"))
    )


def mixing_plan(
    slim: DataFrame,
    weights: tuple[int, ...] | DataFrame = (1, 2, 3),
    passes: int = 3,
    budget: int | None = None,
) -> DataFrame:
    """(source, key, size) -> a row a source: its size, weight, target and where its mix ends.

    The rows are read several times: give a table, or what is cheap to compute.
    Finish times rise along a source's order and from pass to pass, so what the mix takes of a
    source is a beginning of that order: `last_pass` and `last_key` name its last document.
    """
    per_source = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("s"), F.col("weight").cast("double"))
        per_source = per_source.join(given, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        per_source = per_source.fillna(1.0, ["weight"])
    else:
        per_source = cycled_weights(per_source, weights)
    sources = materialised(with_targets(per_source, budget, passes), "mixing-targets")
    if budget is None:
        budget = sources.agg(F.sum("source_size")).first()[0] or 0
    info = sources.withColumnRenamed("source", "s")
    of_source = F.col("source").eqNullSafe(F.col("s"))
    finish = (F.col("pass") * F.col("source_size") + F.col("upto")) / F.col("weight")
    turns = (
        _places(slim)
        .join(info.filter("weight > 0"), of_source)
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
        .select("source", "key", "pass", "place_size", finish.alias("finish"))
    )
    order = ["finish", "source", "key", "pass"]
    tasks = max(1, int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = turns.repartitionByRange(tasks, *order).withColumn("task", F.spark_partition_id())
    ranged = materialised(ranged, "mixing-turns")
    before = prefix_sums(
        ranged.groupBy("task").agg(F.sum("place_size").alias("n")), [], "task", "n", "before"
    ).drop("n")
    w = Window.partitionBy("task").orderBy(*order)
    upto = F.col("before") + F.sum("place_size").over(w)
    chosen = ranged.join(before, "task").withColumn("upto", upto).filter(F.col("upto") <= budget)
    ends = chosen.groupBy("source").agg(F.max(F.struct("pass", "key")).alias("last"))
    plan = ends.withColumnRenamed("source", "es").join(
        info, F.col("es").eqNullSafe(F.col("s")), "right"
    )
    plan = plan.select(
        F.col("s").alias("source"),
        "source_size",
        "weight",
        "target",
        F.col("last.pass").alias("last_pass"),
        F.col("last.key").alias("last_key"),
    )
    return materialised(plan, "mixing-plan")


def _places(slim: DataFrame) -> DataFrame:
    """One row a place of the shuffled order: source, key, place_size, upto.

    `upto` counts the words of the source up to and including the place.
    """
    keyed = slim.filter("size > 0").withColumn("bucket", F.substring("key", 1, DIGITS))
    places = keyed.groupBy("source", "bucket", "key").agg(F.sum("size").alias("place_size"))
    buckets = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = prefix_sums(buckets, ["source"], "bucket", "n", "before").select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "before"
    )
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))
    w = Window.partitionBy("source", "bucket").orderBy("key")
    places = places.withColumn("within", F.sum("place_size").over(w))
    upto = F.col("before") + F.col("within")
    return places.join(before, same).select("source", "key", "place_size", upto.alias("upto"))


def _with_times(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """Join the plan of each row's source and add `times`. The plan has a row a source."""
    info = plan.select(F.struct(*plan.columns).alias("mix_plan"))
    mine = F.col("mix.source").eqNullSafe(F.col("mix_plan.source"))
    again = (F.col("mix.key") <= F.col("mix_plan.last_key")).cast("long")
    times = F.when(F.col("mix.size") > 0, F.coalesce(F.col("mix_plan.last_pass") + again, F.lit(0)))
    return keyed.join(info, mine).withColumn("mix_times", F.coalesce(times, F.lit(0)).cast("long"))


def fair_mix(
    docs: DataFrame,
    weights: tuple[int, ...] | DataFrame = (1, 2, 3),
    passes: int = 3,
    budget: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row: id, source, size, source_size, target, times, taken.

    `times` is how often the mix takes the document, `taken` the words that makes. Weights are a
    cycle over the sorted sources or a table (source, weight). The budget is all words unless
    given; the first document beyond it ends the mix. The shuffled order is by the MD5 of id and
    text: reruns agree, and rows that are equal in both share one place and one fate. A null
    source is a source of its own, sorted last. Null and wordless texts have size 0 and are
    never taken. No rows give no rows. Other columns are neither read nor returned.
    """
    keyed = _keyed(docs, id_col, text_col, source_col).select(F.col(id_col).alias("id"), "mix")
    slim = materialised(keyed, "mixing-rows")
    rows = _with_times(slim, mixing_plan(slim.select("mix.*"), weights, passes, budget))
    return rows.select(
        F.col("id").alias(id_col),
        "mix.source",
        "mix.size",
        "mix_plan.source_size",
        "mix_plan.target",
        F.col("mix_times").alias("times"),
        (F.col("mix_times") * F.col("mix.size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] | DataFrame = (1, 2, 3),
    passes: int = 3,
    budget: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with the columns of docs.

    Texts are not shuffled unless there are too many sources for a broadcast by Spark's own check.
    """
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    inner = [f"row.{c}" for c in (id_col, text_col, source_col)]
    keyed = _keyed(packed, *inner)
    slim = materialised(keyed.select("mix.*"), "mixing-rows")
    plan = mixing_plan(slim, weights, passes, budget)
    repeated = _with_times(keyed, plan).filter("mix_times > 0")
    one = F.explode(F.sequence(F.lit(1), F.col("mix_times")))
    return repeated.withColumn("mix_turn", one).select(F.col("row.*"))
