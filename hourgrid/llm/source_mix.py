"""Mix sources to target weights by Pareto order sampling.

Every source gets a target number of words: a share of all words dealt by
weight, at most ``max_copies`` times its own size, the excess dealt again among
the sources that have room. A document is then expected in
``target / source size`` copies. The whole part of that number is certain; the
fraction is an inclusion probability p, and documents are ranked by

    (u / (1 - u)) / (p / (1 - p)),    u a hash of the id in (0, 1),

the random odds divided by the inclusion odds. A source takes documents in this
order up to its number of words. ``weight_col`` makes p unequal inside a source.

No task holds a source: words are added up per source and slice of the ranking,
the slice where the target falls is found, and only its documents are put in
order. What is left of the target is filled by later passes over the documents
small enough to fit, and by one last document where that comes nearer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from hourgrid.llm.frames import stage, unit_hash

WORD = r"[^\x20\x09-\x0D]+"
SLICES = 16_384
PASSES = 3


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """Add ``ordinal``, 0-based by code point with NULL last, without one task for all."""
    placed = stage(
        sources.repartitionByRange("no_source", "source").withColumn("part", F.spark_partition_id())
    )
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("earlier"))
    inside = Window.partitionBy("part").orderBy("no_source", "source")
    return placed.join(earlier, "part").withColumn(
        "ordinal", F.col("earlier") + F.row_number().over(inside) - 1
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, max_copies: int
) -> DataFrame:
    """Per source: ``source_size``, ``target``. ``sizes``: no_source, source, size.

    The level is raised until no source is above its limit; each round is one
    aggregate over the source table, of which only two sums reach the driver.
    """
    sources = sizes.groupBy("no_source", "source").agg(F.sum("size").alias("source_size"))
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("ordinal") % len(weights)).cast("int") + 1)
    numbered = stage(
        _numbered(sources).select(
            "no_source", "source", "source_size", pick.alias("weight"),
            (F.col("source_size") * max_copies).cast("double").alias("most"),
        )
    )
    total = numbered.agg(F.sum("source_size")).first()[0] or 0
    level, goal = 0.0, share * total
    while True:
        full = F.col("weight") * F.lit(level) >= F.col("most")
        filled, open_weight = numbered.agg(
            F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not open_weight:
            break
        raised = (goal - (filled or 0.0)) / open_weight
        if raised <= level:
            break
        level = raised
    return numbered.select(
        "no_source", "source", "source_size",
        F.least(F.col("weight") * F.lit(level), F.col("most")).alias("target"),
    )


def _cut(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """Where each source's order reaches its need: ``cut`` (the last taken place) and ``gap``.

    ``rows``: no_source, source, place (struct v, id, row), size. ``needs``: no_source, source, need.
    """
    keys = ["no_source", "source"]
    sliced = rows.withColumn("slice", F.floor(F.col("place.v") * SLICES))
    slices = sliced.groupBy(*keys, "slice").agg(F.sum("size").alias("words"))
    running = Window.partitionBy(*keys).orderBy("slice")
    edges = (
        slices.withColumn("upto", F.sum("words").over(running))
        .join(needs, keys)
        .groupBy(*keys, "need")
        .agg(
            F.min(F.when(F.col("upto") > F.col("need"), F.col("slice"))).alias("edge"),
            F.max(F.when(F.col("upto") <= F.col("need"), F.col("upto"))).alias("before"),
        )
        .withColumn("before", F.coalesce("before", F.lit(0)))
    )
    order = Window.partitionBy(*keys).orderBy("place")
    inside = (
        sliced.join(edges.where("edge IS NOT NULL").select(*keys, "edge", "need", "before"), keys)
        .where(F.col("slice") == F.col("edge"))
        .withColumn("upto", F.col("before") + F.sum("size").over(order))
        .where(F.col("upto") <= F.col("need"))
        .groupBy(*keys)
        .agg(F.max("place").alias("last"), F.max("upto").alias("reached"))
    )
    nothing = F.struct(
        F.coalesce(F.col("edge") / F.lit(float(SLICES)), F.lit(2.0)).alias("v"),
        F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("long").alias("row"),
    )
    return edges.join(inside, keys, "left").select(
        *keys,
        F.coalesce("last", nothing).alias("cut"),
        (F.col("need") - F.coalesce("reached", "before")).alias("gap"),
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_copies: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight_col: str | None = None,
    passes: int = PASSES,
) -> DataFrame:
    """One row per document: id, size, source_size, target, copies, taken.

    ``taken`` is ``copies * size``. Rows are the same on every run for the same
    ids. Defined cases: NULL text has size 0 and is taken 0 words; a NULL source
    is a source of its own, last in order; rows with equal ids have equal luck
    and are separated by their place in the input; ids are of any type, rows without one have their text's luck; a NULL or non-positive weight
    counts as 0: such a document is taken only if every weight of its source is 0;
    an empty table gives an empty result; further columns are ignored.
    """
    source = F.col(source_col).cast("string")
    weight = F.lit(1.0) if weight_col is None else F.greatest(F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            # Rows without an id are told apart by their text; other rows have NULL here, which a hash passes over.
            F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col))).alias("nameless"),
            source.isNull().cast("int").alias("no_source"),
            F.coalesce(source, F.lit("")).alias("source"),
            count_words(F.col(text_col)).alias("size"),
            weight.alias("weight"),
        )
    )
    keys = ["no_source", "source"]
    targets = source_targets(rows.select(*keys, "size"), weights, share, max_copies)
    # With unequal weights, weight * size is what a source's target is spread over.
    spread = rows.groupBy(*keys).agg(F.sum(F.col("weight") * F.col("size")).alias("weighted"))
    plan = stage(
        targets.join(spread, keys).withColumn("flat", F.col("weighted") <= 0)
        .withColumn("rate", F.when(F.col("source_size") == 0, 0.0).when(F.col("flat"), F.col("target") / F.col("source_size")).otherwise(F.col("target") / F.col("weighted")))
    )
    wanted = F.least(F.when(F.col("flat"), F.col("rate")).otherwise(F.col("rate") * F.col("weight")), F.lit(float(max_copies)))
    whole = F.floor(F.col("wanted") + F.lit(1e-9))
    chance = F.least(F.greatest(F.col("wanted") - F.col("whole"), F.lit(0.0)), F.lit(1.0 - 1e-12))
    luck = unit_hash(F.lit(seed), F.col("id"), F.col("nameless"))
    # Breaks ties of equal luck.
    tie = F.col("id").cast("long") if isinstance(rows.schema["id"].dataType, IntegralType) else F.xxhash64("id")
    odds = (F.col("luck") / (1 - F.col("luck"))) / (F.col("chance") / (1 - F.col("chance")))
    ranked = stage(
        rows.join(plan.select(*keys, "rate", "flat"), keys)
        .withColumn("wanted", wanted)
        .withColumn("whole", whole.cast("int"))
        .withColumn("chance", F.when(chance > 1e-9, chance).otherwise(F.lit(0.0)))
        .withColumn("luck", luck)
        .select(
            *keys, "size", "whole",
            F.struct(
                F.when(F.col("chance") > 0, odds / (1 + odds)).otherwise(F.lit(1.5)).alias("v"),
                tie.alias("id"), "row",
            ).alias("place"),
            F.col("id").alias("out_id"),
        )
    )
    certain = ranked.groupBy(*keys).agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    needs = plan.join(certain, keys).select(*keys, (F.col("target") - F.col("certain")).alias("need"))
    open_rows = ranked.where((F.col("place.v") < 1) & (F.col("size") > 0)).select(*keys, "place", "size")
    limits = plan.select(*keys, "source_size", "target")
    for k in range(passes):
        cut = stage(_cut(open_rows, needs))
        limits = limits.join(
            cut.select(*keys, F.col("cut").alias(f"cut{k}"), F.col("gap").alias(f"gap{k}")), keys, "left"
        )
        open_rows = open_rows.join(cut, keys).where((F.col("place") > F.col("cut")) & (F.col("size") <= F.col("gap"))).select(*keys, "place", "size")
        needs = cut.select(*keys, F.col("gap").alias("need"))
    # The same rule, read per row: taken by the first pass that the row reached.
    place = F.col("place")
    taken = F.lit(False)
    for k in reversed(range(passes)):
        reached = place <= F.col(f"cut{k}")
        taken = reached if k == passes - 1 else F.when(reached, True).otherwise((F.col("size") <= F.col(f"gap{k}")) & taken)
    extra = F.when((place["v"] < 1) & (F.col("size") > 0), F.coalesce(taken, F.lit(False))).otherwise(F.lit(False))
    limited = ranked.join(stage(limits), keys).withColumn("extra", extra)
    # One more document where that comes nearer to the target than stopping short of it.
    short = F.coalesce(*[F.col(f"gap{k}") for k in reversed(range(passes))])
    over = (place["v"] < 1) & ~F.col("extra") & (F.col("size") > 0) & (F.col("size") < 2 * short)
    topped = limited.where(over).groupBy(*keys).agg(F.min(F.struct("size", "place")).alias("top"))
    limited = limited.join(stage(topped), keys, "left")
    extra = F.col("extra") | F.coalesce(place == F.col("top.place"), F.lit(False))
    copies = F.col("whole") + extra.cast("int")
    return limited.select(
        F.col("out_id").alias(id_col), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
    )
