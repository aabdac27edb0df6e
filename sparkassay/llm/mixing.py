"""Mixing sources to target weights along a low-discrepancy schedule, with DataFrame operations only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.session import cut_lineage

#: The golden ratio's fraction in units of 2^-31 (an odd number) and that unit.
GOLDEN, UNIT = 1327217885, 2147483648
WORD = r"[^\x20\x09-\x0D]+"
#: Cells of the unit interval by which points meet the sources' stretches of it.
CELLS = 1024
#: A source has at least so many blocks (or one per word); a smaller one gets smaller blocks.
LEAST_BLOCKS = 256


@dataclass(frozen=True)
class Mix:
    """``documents``: a row per document; ``schedule``: a row per slot; ``pieces``: the documents of each block."""

    documents: DataFrame
    schedule: DataFrame
    pieces: DataFrame


def running(value: str, by: list[str], order: list[str]) -> Column:
    """Sum of the rows before this one."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), limit: float = 3.0) -> DataFrame:
    """``source, source_size`` with ``nth, target``, a row per source.

    Sources in code-point order (null last) take the weights in turn and share all words by weight. No target exceeds
    ``limit`` times its source; the excess is shared again until none does: the water level, found in one pass over
    the sources ordered by limit / weight.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    out = sizes.withColumn("nth", turn).withColumn("weight", weight)
    out = out.withColumn("most", F.col("source_size") * F.lit(float(limit)))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "nth")
    every = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(every) - F.coalesce(
        F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    level = rest / F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    out = out.withColumn("level", F.when(level * F.col("weight") <= F.col("most"), level))
    out = out.withColumn("level", F.first("level", ignorenulls=True).over(every))
    target = F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return out.select("source", "source_size", "nth", target.alias("target"))


def mix_sources(
    docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: tuple[float, ...] = (1.0, 2.0, 3.0), limit: float = 3.0, block_words: int | None = None,
    seed: str = "mix",
) -> Mix:
    """Words of each document that a mix with the target weights takes, and the order in which it takes them.

    A document's size is its number of words. The documents of a source, in the order of a hash of their ids, form a
    line of words that is cut into blocks of ``block_words`` (default: 2048, less if there were fewer than 2^17 blocks);
    a long document lies in several. A source of fewer than ``LEAST_BLOCKS`` such blocks is cut into that many smaller
    ones (at least a word each) and its share of the slots grows as its blocks shrink, so it also meets its target. Slot ``i`` of the schedule is the point frac(i x golden ratio), which falls into
    one source's stretch of the cumulative targets; the r-th slot of a source is its r-th block, starting again after
    the last, so every prefix of the schedule is close to the weights. No document is taken more than ``limit`` times.

    ``documents``: ``id_col, source, size, source_size, target, taken, copies`` (copies: how often its first word is
    taken). ``schedule``: ``slot, source_key, block, pass``. ``pieces``: ``source_key, block, id_col, words``. Running
    totals are taken in hash buckets and over bucket totals, so a source with a third of all rows is spread evenly.

    A null text has size 0, takes part with nothing and has 0 taken; a null source is a source of its own; null or
    repeated ids are rows like all others; an empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    source = F.col(source_col).cast("string")
    sized = cut_lineage(
        docs.select(
            F.col(id_col).alias("id"), source.alias("source"),
            F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source)).alias("source_key"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string"))).alias("key"),
        ).withColumn("bucket", F.substring("key", 1, 3)),
        "sizes",
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    words = block_words or max(1, min(2048, total // 2**17))

    sources = sized.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, limit)
    targets = targets.withColumn(
        "source_key", F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("source")))
    )
    finer = F.greatest(F.lit(1), F.floor(F.col("source_size") / LEAST_BLOCKS))
    small = F.col("source_size") < LEAST_BLOCKS * words
    targets = targets.withColumn("block_words", F.when(small, F.least(finer, F.lit(words))).otherwise(F.lit(words)).cast("long"))
    targets = targets.withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_words")))
    # in words of a usual block; by the mean size of its blocks where a source has its own
    targets = targets.withColumn("points", F.when(
        F.col("block_words") < words, F.col("target") / F.col("source_size") * F.col("blocks") * words
    ).otherwise(F.col("target")))
    own = targets.agg(F.max(F.col("block_words") < words), F.sum("points")).first()
    slots = math.ceil(own[1] / words) if own[0] else -(-total // words)
    # places of the documents in their source's line of words
    totals = sized.groupBy("source_key", "bucket").agg(F.sum("size").alias("in_bucket"))
    totals = totals.withColumn("before", running("in_bucket", ["source_key"], ["bucket"])).drop("in_bucket")
    placed = sized.withColumn("within", running("size", ["source_key", "bucket"], ["key", "id", "size"]))
    placed = placed.join(totals, ["source_key", "bucket"]).withColumn("begin", F.col("before") + F.col("within"))
    placed = placed.join(targets.select("source_key", "source_size", "target", "block_words"), "source_key")
    facts = ["id", "source", "size", "source_size", "target"]
    full = placed.where(F.col("size") > 0).withColumn("end", F.col("begin") + F.col("size"))
    pieces = full.select(
        "source_key", "begin", "end", *facts, "block_words",
        F.explode(F.sequence(
            F.floor(F.col("begin") / F.col("block_words")), F.floor((F.col("end") - 1) / F.col("block_words"))
        )).alias("block"),
    )
    low = F.col("block") * F.col("block_words")
    pieces = pieces.withColumn("words", F.least("end", low + F.col("block_words")) - F.greatest("begin", low))
    # the schedule: points to sources, ranks per source, ranks to blocks
    bound = Window.orderBy("nth")
    share = F.sum("points").over(bound) / F.sum("points").over(Window.partitionBy())
    stretches = targets.where("target > 0").withColumn("high", F.floor(share * UNIT))
    stretches = stretches.withColumn("low", F.coalesce(F.lag("high").over(bound), F.lit(0))).where("high > low")
    cell = UNIT // CELLS
    stretches = stretches.select(
        "source_key", "low", "high", "blocks",
        F.explode(F.sequence(F.floor(F.col("low") / cell), F.floor((F.col("high") - 1) / cell))).alias("cell"),
    )
    point = (F.col("id") % UNIT) * GOLDEN % UNIT
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") / cell))
    points = points.join(stretches, "cell").where("point >= low and point < high")
    chunk = max(4096, int(slots**0.5))
    points = points.withColumn("chunk", F.floor(F.col("slot") / chunk)).select(
        "slot", "source_key", "blocks", "chunk",
        (F.row_number().over(Window.partitionBy("source_key", "chunk").orderBy("slot")) - 1).alias("nth"),
    )
    chunks = points.groupBy("source_key", "chunk").agg(F.count("*").alias("n"))
    chunks = chunks.select("source_key", "chunk", running("n", ["source_key"], ["chunk"]).alias("before"))
    ranked = points.join(chunks, ["source_key", "chunk"]).withColumn("rank", F.col("before") + F.col("nth"))
    schedule = ranked.select(
        "slot", "source_key", (F.col("rank") % F.col("blocks")).alias("block"),
        F.floor(F.col("rank") / F.col("blocks")).alias("pass"),
    ).where(F.col("pass") < int(limit))

    passes = schedule.groupBy("source_key", "block").agg(F.count("*").alias("passes"))
    used = pieces.join(passes, ["source_key", "block"], "left").withColumn("passes", F.coalesce("passes", F.lit(0)))
    used = used.groupBy("source_key", "begin", *facts).agg(
        F.sum(F.col("words") * F.col("passes")).alias("taken"), F.min_by("passes", "block").alias("copies")
    )
    nothing = placed.where(F.col("size") == 0).select(*facts, F.lit(0).alias("taken"), F.lit(0).alias("copies"))
    documents = used.select(*facts, "taken", "copies").unionByName(nothing).withColumnRenamed("id", id_col)
    return Mix(documents, schedule, pieces.select("source_key", "block", F.col("id").alias(id_col), "words"))
