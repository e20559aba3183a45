"""Mixing sources to target weights with exact budgets.

Every document gets a hash-random key. Keys are uniform, so equal ranges of them are ranges of
equal size: ``range`` is the key's place among a source's ranges, as many as its rows call for.
Sizes are summed per range, the sums are added up along each source, and within a range
the rows are sorted by key. Together these give each row's position in its source without
any task seeing a whole source. A source is then cut at its budget: whole epochs first, then
the rows up to the remaining words.

Rows that repeat have one key. They are counted first, placed as one group, and what each copy gives follows
from the group's place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.joins import repeated, spread_join
from docloom.operators.paging import global_row_number
from docloom.workspace import stage

#: Weights of the sources in order, repeating; targets stop at so many times a source.
WEIGHTS = (5, 2, 1)
EPOCHS = 3
#: Rows that one range of keys holds on average.
RANGE_ROWS = 20_000
SEED = 42


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The total is shared by weight; a source whose share is above ``epochs`` times its size stops there, and the
    others share what is left, until none is above. Sources are ranked by code point, null last.
    """
    order = [F.col("source").asc_nulls_last()]
    weight = F.element_at(F.lit(list(weights)), (F.pmod(F.col("row") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = stage(
        global_row_number(sources, order, "row").select(
            "source", "source_size", weight.cast("double").alias("weight")
        ),
        "ranked",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * F.lit(epochs)
    share, before = 0.0, -1
    while True:
        # one row of totals: what the stopped sources take, and the weight of the others
        stopped = cap < F.col("weight") * F.lit(share)
        row = ranked.agg(
            F.sum(F.when(stopped, cap).otherwise(0)).alias("taken"),
            F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(stopped.cast("long")).alias("n"),
        ).first()
        if row.n is None or not row.weight or row.n == before:
            break
        share, before = (total - row.taken) / row.weight, row.n
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(share))
    return ranked.select("source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, whole: bool = False, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target and taken, with the source and key of every row.

    ``taken`` counts words with repeats. The sums over a source equal its target rounded
    down: the row at the cut gives its first words only. With ``whole`` that row is
    taken in full if this brings the sum nearer, and else not. Null texts and texts without
    words have size 0 and give 0; a null source is a source. Rows that repeat lie one behind the
    other and share what they give at will, as they are equal; keys that tie are ordered by id. A
    text of any length is one row of its size.
    """
    base = stage(
        docs.select(
            "doc_id",
            "source",
            n_words(F.col("text")).alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", F.xxhash64("text")).alias("key"),
        )
        .groupBy("doc_id", "source", "size", "key")
        .agg(F.count("*").alias("copies")),
        "sizes",
    )
    summed = stage(
        base.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("rows")),
        "sources",
    )
    wanted = targets(summed.select("source", "source_size"))
    plan = stage(
        summed.select(F.col("source").alias("of"), F.ceil(F.col("rows") / RANGE_ROWS).alias("ranges"))
        .join(wanted, F.col("of").eqNullSafe(F.col("source")))
        .select("source", "source_size", "target", "ranges"),
        "plan",
    )
    named = base.withColumnRenamed("source", "own")
    unit = (F.shiftrightunsigned("key", 11)).cast("double") / F.lit(float(1 << 53))
    placed = stage(
        named.join(plan, F.col("own").eqNullSafe(F.col("source")))
        .withColumn("range", F.floor(unit * F.col("ranges")))
        .drop("own", "ranges"),
        "placed",
    )
    sums = placed.groupBy("source", "range").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("own"),
        F.col("range").alias("at"),
        F.coalesce(F.sum("words").over(along), F.lit(0)).alias("base"),
    )
    inside = (
        Window.partitionBy("source", "range")
        .orderBy(F.shiftrightunsigned("key", 11), "key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    run = placed.withColumn("within", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("own")) & (F.col("range") == F.col("at"))
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    copies = repeated(run, "copies", "copy")
    start = F.col("base") + F.col("within") + F.col("copy") * F.col("size")
    if whole:
        last = F.when(2 * start + F.col("size") <= 2 * rest, F.col("size")).otherwise(0)
    else:
        last = F.least(F.greatest(rest - start, F.lit(0)), F.col("size"))
    return copies.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + last).cast("long").alias("taken"),
        "source",
        "key",
    )


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, each whole.

    Rows that agree in id, source and text are taken alike, the number of copies being the
    largest that any of them got; rows without words are never taken.
    """
    key, copies, copy, weight = (_unused(docs.columns, name) for name in ("key", "copies", "copy", "weight"))
    taken = (
        mixed(docs, whole=True)
        .filter("size > 0 AND taken > 0")
        .groupBy(F.col("key").alias(key))
        .agg(F.max(F.expr("taken div size")).cast("int").alias(copies), F.count("*").alias(weight))
    )
    keyed = docs.withColumn(key, F.xxhash64(F.lit(SEED), "doc_id", F.xxhash64("text")))
    return (
        spread_join(keyed, stage(taken, "taken"), [key], weight)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .select(*docs.columns)
    )


def _unused(names: list[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    while name.lower() in {x.lower() for x in names}:
        name = "_" + name
    return name
