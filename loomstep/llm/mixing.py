"""Mixing of sources to target weights: Sainte-Laguë quotas of equal blocks, then seeded selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomstep.llm.common import discard, materialize, word_count

#: Words in a block.
BLOCK = 16
#: Documents in a shard, about, until a source has so many shards; beyond, their number grows as the root of its documents'.
PER_SHARD, MANY_SHARDS = 500, 4096
WEIGHTS = (5, 2, 1)


def _by_source() -> list[Column]:
    """The order of sources: by code points, null last."""
    return [F.col("source").isNull(), F.encode(F.col("source"), "UTF-8")]


def in_order(df: DataFrame, order: list[Column], before: dict[str, Column]) -> DataFrame:
    """df with the sum of each column of before over all rows that come earlier in the order (0 for the first), under its name.

    Rows are dealt out by ranges of the order and written down, so no task has all of them; what comes before a range
    is summed from a table of a row for each range, no more than there are shuffle partitions.
    """
    parts = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = parts.groupBy("_part").agg(*(F.sum(c).alias(n) for n, c in before.items()))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(F.col("_part").alias("_p"), *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_start{n}") for n in before))
    line = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inside = parts.select("*", *(F.coalesce(F.sum(c).over(line), F.lit(0)).alias(n) for n, c in before.items()))
    found = inside.join(starts, F.col("_part") == F.col("_p"))
    return found.select(*df.columns, *((F.col(f"_start{n}") + F.col(n)).alias(n) for n in before))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """sources (source, size) with target: share of all sizes by weight, none above most times its size.

    Sources in order of code points, null last, have the weights in turn. What a source can't take goes to
    the others by weight until none is above: with sources sorted by size over weight, those up to some place
    are full and the others have one common rate. The driver sees sums and that rate. An empty table gives no rows.
    """
    placed = in_order(sources, _by_source(), {"_place": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("_place"), F.lit(len(weights))).cast("int") + 1)
    rows = placed.withColumn("weight", weight.cast("long")).withColumn("full", most * F.col("size"))
    ratio = F.col("full") / F.col("weight")
    rows = in_order(rows, [ratio, *_by_source()], {"_full": F.col("full"), "_weight": F.col("weight")})
    size, heavy = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    rate = (F.lit(share[0] * size / share[1]) - F.col("_full")) / (F.lit(heavy) - F.col("_weight"))
    # The first source that isn't full sets the rate of all that follow.
    first = rows.where(F.col("full") > rate * F.col("weight")).agg(F.min(F.struct(ratio.alias("ratio"), rate.alias("rate"))).alias("m")).first()["m"]
    full = F.col("full").cast("double")
    target = full if first is None else F.least(full, F.lit(first["rate"]) * F.col("weight"))
    out = materialize(rows.select("source", "size", target.alias("target")), "targets")
    discard(placed, rows)
    return out


def sainte_lague(units: DataFrame, group: list[str], votes: str, seats: Column, ties: list[Column], out: str) -> DataFrame:
    """units with seats of their group, given one by one to the unit of the highest quotient votes / (2 * held + 1).

    With the divisor sum(votes) / seats a unit's share is off its final seats by no more than its part of
    half the number of units, so only quotients near that share are ranked; those above are granted and
    those below are not. Ranked rows are about five times the units. Units without votes get none.
    A group is ranked in one task; without group columns all units are one group, ranked by ranges of the quotient.
    """
    every = W.partitionBy(*group)
    if group:
        rows = units.withColumn("_all", F.sum(votes).over(every)).withColumn("_n", F.count(F.lit(1)).over(every)).withColumn("_seats", seats)
    else:
        total, n = units.agg(F.coalesce(F.sum(votes), F.lit(0)), F.count(F.lit(1))).first()
        rows = units.withColumn("_all", F.lit(total)).withColumn("_n", F.lit(n)).withColumn("_seats", seats)
    share = F.when(F.col("_all") > 0, F.col(votes) * F.col("_seats") / F.col("_all")).otherwise(0.0)
    slack = F.when(F.col("_all") > 0, F.col(votes) / F.col("_all") * F.col("_n")).otherwise(0.0) / 2 + 2
    rows = rows.withColumn("_low", F.greatest(F.floor(share - slack), F.lit(0)).cast("long")).withColumn("_high", F.ceil(share + slack).cast("long"))
    ranked = rows.select("*", F.explode(F.sequence("_low", "_high")).alias("_held"))
    order = [(F.col(votes) / (2 * F.col("_held") + 1)).desc(), *ties, F.col("_held")]
    granted = F.sum(F.when(F.col("_held") == F.col("_low"), F.col("_low")))
    if group:
        ranked = ranked.withColumn("_rank", F.row_number().over(every.orderBy(*order)) - 1).withColumn("_left", F.col("_seats") - granted.over(every))
    else:
        ranked = in_order(ranked, order, {"_rank": F.lit(1)})
        ranked = ranked.withColumn("_left", F.col("_seats") - F.lit(ranked.agg(F.coalesce(granted, F.lit(0))).first()[0]))
    won = F.count_if((F.col("_rank") < F.col("_left")) & (F.col(votes) > 0))
    keep = units.columns
    grouped = ranked.groupBy(*keep).agg(F.first("_low").alias("_low"), won.alias("_won"))
    return grouped.select(*keep, F.when(F.col(votes) > 0, F.col("_low") + F.col("_won")).otherwise(0).cast("long").alias(out))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 7,
    block: int = BLOCK,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken[, carry]) for each row.

    Blocks of equal numbers of words, so many as come nearest to the sum of targets, go to sources and then
    to the shards of a source by Sainte-Laguë. In a shard, documents stand in an order seeded by their id and
    are cut into blocks; the quota takes whole rounds of the shard first, then its first blocks. So no
    document gives more than twice its words, and a rerun takes the same. A shard holds about PER_SHARD
    documents (more in sources of over MANY_SHARDS shards), so a large source is dealt out.
    Null texts count as size 0, a null id goes by its text's hash; rows that repeat an id are ordered by size. Sources
    of size 0 have target 0. An empty table gives no rows.
    """
    size = word_count(F.col(f"`{text_col}`"))
    key = F.col(f"`{id_col}`")
    rows = docs.select(key.cast("long").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), size.alias("size"), F.xxhash64(f"`{text_col}`").alias("_text"), *(F.col(f"`{c}`") for c in carry))
    slim = materialize(rows, "sizes")
    totals = slim.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs"))
    targets = source_targets(totals.select("source", "size"))
    # No source's target is above twice its size and all targets are 150 % of all sizes.
    words = targets.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    quotas = sainte_lague(targets, [], "target", F.lit((3 * words + block) // (2 * block)), _by_source(), "quota")
    sources = quotas.join(totals.select(F.col("source").alias("_s"), "docs"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    shards = F.least(F.ceil(F.col("docs") / PER_SHARD), F.greatest(F.lit(MANY_SHARDS), F.ceil(F.sqrt("docs")))).cast("int")
    sources = materialize(sources.select("source", F.col("size").alias("source_size"), "target", "quota", F.greatest(shards, F.lit(1)).alias("shards")), "sources")
    discard(targets, quotas)
    near = sources.withColumnRenamed("source", "_s")
    rank = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id"), F.col("_text")).cast("string")))
    dealt = slim.join(near, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumn("_order", rank)
    number = F.conv(F.substring("_order", 1, 8), 16, 10).cast("long")
    dealt = materialize(dealt.withColumn("shard", F.pmod(number, F.col("shards")).cast("int")), "dealt")
    discard(slim, sources)
    parts = dealt.groupBy("source", "shard", "quota").agg(F.sum("size").alias("votes"))
    parts = sainte_lague(parts, ["source"], "votes", F.max("quota").over(W.partitionBy("source")), [F.col("shard")], "blocks")
    parts = parts.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), F.col("votes").alias("shard_size"), "blocks")
    own = dealt.join(parts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h"))).drop("_s", "_h")
    line = W.partitionBy("source", "shard").orderBy("_order", "size").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum("size").over(line)
    in_shard = F.ceil(F.col("shard_size") / block)
    rounds = F.floor(F.col("blocks") / F.greatest(in_shard, F.lit(1)))
    part = (F.col("blocks") - rounds * in_shard) * block
    inside = F.least(F.col("size"), F.greatest(part - (F.col("_end") - F.col("size")), F.lit(0)))
    taken = F.least(rounds * F.col("size") + inside, 2 * F.col("size"))
    taken = F.when(F.col("size") > 0, taken).otherwise(0).cast("long")
    return own.withColumn("_end", end).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), *(f"`{c}`" for c in carry))
