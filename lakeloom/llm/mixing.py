"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

The mix is a row of slots, each worth one block of words. The points of a van der Corput sequence, mapped
through the cumulative target weights, say which source fills which slot, so every stretch of the mix
holds the sources in about their shares. The slots of a source, ranked by place, take the blocks of its
shuffled documents in turn, and start over when it has no more.

Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import materialize

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixSettings:
    """``weights`` repeat over the sources by code point, nulls last. The mix takes ``share`` of all words
    and no source more than ``repeats`` times. ``slot_bits``: the schedule has ``2**slot_bits`` points.
    ``buckets``: stretches of a source's shuffled documents that are summed apart."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    repeats: int = 2
    slot_bits: int = 16
    buckets: int = 4096


def source_key(source: Column) -> Column:
    """Text that sorts sources by code point, nulls last, and tells a null from any text."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def source_targets(sized: DataFrame, settings: MixSettings) -> DataFrame:
    """(key, source_size, target) of each source, from (key, size, copies).

    Targets are the water level: weight times one common factor, or the source's cap where that is less. With
    sources sorted by cap per weight, the factor is the first that stays below the next cap, so one
    pass over one row per source replaces the rounds of sharing out what is left.
    """
    sizes = sized.groupBy("key").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    weight = F.element_at(F.array(*(F.lit(w) for w in settings.weights)), F.pmod(F.col("place") - 1, F.lit(len(settings.weights))) + 1)
    by_name = Window.orderBy("key")
    ranked = sizes.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight.cast("long"))
    cap = F.col("source_size") * settings.repeats
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    wanted = F.sum("source_size").over(everything) * F.lit(settings.share)
    levelled = ranked.withColumn("cap", cap).select(
        "*",
        ((wanted - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))).alias("level"),
    )
    fits = F.col("level") * F.col("weight") < F.col("cap")
    first = F.min(F.when(fits, F.struct((F.col("cap") / F.col("weight")).alias("ratio"), "key", "level")))
    share = F.col("common") * F.col("weight")
    return levelled.withColumn("common", first.over(everything)["level"]).select(
        "key",
        "place",
        "source_size",
        F.when(F.col("common").isNull() | (share >= F.col("cap")), F.col("cap").cast("double"))
        .otherwise(share)
        .alias("target"),
    )


def slots(targets: DataFrame, settings: MixSettings) -> DataFrame:
    """(key, block, slot): which slot of the mix takes which block of a source's stream.

    A source owns a stretch of the unit interval as long as its share; the points ``j / 2**slot_bits`` in
    it come up in the order of their reversed bits. It uses as many as its target has blocks; if its
    stretch holds fewer, which is by one at most, the rest follow at the end.
    """
    bits = settings.slot_bits
    points = 1 << bits
    total = F.sum("target").over(Window.partitionBy())
    high = F.sum("target").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    stretches = targets.where("blocks > 0").select(
        "key",
        "blocks",
        F.ceil((high - F.col("target")) / total * points).alias("low"),
        F.least(F.ceil(high / total * points), F.lit(points)).alias("high"),
    )
    owned = stretches.where("high > low").select(
        "key", "blocks", F.explode(F.sequence("low", F.col("high") - 1)).alias("point")
    )
    turned = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    order = Window.partitionBy("key").orderBy("slot")
    ranked = owned.withColumn("slot", turned).withColumn("block", F.row_number().over(order).cast("long") - 1)
    late = stretches.where(F.col("blocks") > F.col("high") - F.col("low")).select(
        "key", F.explode(F.sequence(F.greatest(F.col("high") - F.col("low"), F.lit(0)), F.col("blocks") - 1)).alias("block")
    )
    return (
        ranked.where("block < blocks")
        .select("key", "block", "slot")
        .unionByName(late.withColumn("slot", F.lit(points) + F.col("block")))
    )


def positions(sized: DataFrame, targets: DataFrame, settings: MixSettings) -> DataFrame:
    """Each document's place in the shuffled stream of its source.

    The order is by md5 of the whole row, then id and size. Sums run within stretches of digests and over the sums
    of the stretches, so no source is one task; rows that are equal in all of it are one row with its number of ``copies``, which
    follow each other in the stream.
    """
    by_bucket = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sized.groupBy("key", "bucket")
        .agg(F.sum(F.col("size") * F.col("copies")).alias("held"))
        .select("key", "bucket", F.coalesce(F.sum("held").over(by_bucket), F.lit(0)).alias("offset"))
    )
    order = Window.partitionBy("key", "bucket").orderBy("digest", "doc_id", "size")
    held = F.sum(F.col("size") * F.col("copies"))
    before = F.coalesce(held.over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        sized.withColumn("before", before)
        .withColumn("row", F.row_number().over(order))
        .join(offsets, ["key", "bucket"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("start", F.col("offset") + F.col("before") + F.col("copy") * F.col("size"))
        .join(targets.select("key", "source_size", "target", "take", "block_size"), "key")
        .drop("digest", "offset", "before", "copies")
    )


def schedule(
    docs: DataFrame,
    settings: MixSettings = MixSettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The mix as pieces of documents: (slot, doc_id, first_word, words, ...), slots in mix order.

    Every document has a row at least; one that the mix does not take, such as a text without words, has
    a row with null ``slot`` and 0 ``words``. ``(key, bucket, row, copy)`` tells rows of the input apart, also
    repeated ones. A null text has no words, null sources are one source, sources of no words get target 0. Reruns
    give the same rows, in whatever order the input comes.
    """
    digits = len(f"{settings.buckets - 1:x}")
    size = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long")
    # Of the text as well as the id, so that rows of one id, or of none, are spread.
    text = F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary"))
    parts = F.concat_ws("|", F.coalesce(F.col(id_column).cast("string"), F.lit("")), text)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        source_key(F.col(source_column)).alias("key"),
        F.md5(parts.cast("binary")).alias("digest"),
        size.alias("size"),
    )
    # Equal rows are counted in each task before any are shuffled.
    sized = rows.groupBy("key", "digest", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    sized = materialize(sized.withColumn("bucket", F.substring("digest", 1, digits)), "mix-sizes")
    total = F.sum("target").over(Window.partitionBy())
    block = F.greatest(F.ceil(total / F.lit(1 << settings.slot_bits)), F.lit(1))
    targets = (
        source_targets(sized, settings)
        .withColumn("take", F.floor("target"))
        .withColumn("block_size", block)
        .withColumn("blocks", F.ceil(F.col("take") / F.col("block_size")))
    )
    targets = materialize(targets, "mix-targets")
    placed = positions(sized, targets, settings)
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(settings.repeats - 1)), lambda turn: turn * F.col("source_size") + F.col("start")
    )
    turns = placed.withColumn("at", F.explode(starts)).withColumn(
        "until", F.least(F.col("at") + F.col("size"), F.col("take"))
    )
    # A turn the mix does not reach has no blocks; the row stays, so that every document has one.
    blocks = F.when(
        F.col("until") > F.col("at"),
        F.sequence(F.floor(F.col("at") / F.col("block_size")), F.floor((F.col("until") - 1) / F.col("block_size"))),
    )
    pieces = turns.withColumn("block", F.explode_outer(blocks))
    low = F.greatest("at", F.col("block") * F.col("block_size"))
    high = F.least("until", (F.col("block") + 1) * F.col("block_size"))
    return pieces.join(slots(targets, settings), ["key", "block"], "left").select(
        "slot",
        "doc_id",
        (low - F.col("at")).alias("first_word"),
        F.when(F.col("slot").isNotNull(), high - low).otherwise(0).alias("words"),
        "size",
        "source_size",
        "target",
        "key",
        "bucket",
        "row",
        "copy",
    )


def taken(pieces: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row per document row of a schedule."""
    return (
        pieces.groupBy("key", "bucket", "row", "copy", "doc_id", "size", "source_size", "target")
        .agg(F.sum("words").alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken")
    )
