"""Mixing sources to target weights by Pfair scheduling.

A source's documents form blocks. With weight ``w``, its block ``j`` is released at slot
``floor(j / w)`` and due before slot ``ceil((j + 1) / w)``. In every slot the released block with
the earliest deadline goes next (ties: the smaller source). As long as every source has blocks
left, after any number of slots each source is less than one block away from its share.

Weights are whole numbers of ``PRECISION`` steps of the largest one, and releases and deadlines are
exact in them. The schedule is worked out until the last block of the slowest source, in parts of ``LIMIT``
slots side by side; the bound holds throughout. Block ``j`` of a source finds its slot by a join. Within a source,
documents are put in the order of a seeded hash of their id and numbered without a window over the
source: each is placed in a slice of the hash range, and the slices' counts are added up.

Cases: a NULL source is a source of its own. A source without a weight above 0 has no slots: its
slot is NULL and it follows after all scheduled ones; one below ``2 / LIMIT`` of all weights counts as about
that. When a source runs out, its slots are left out and the others go on in the same order. No document
is dropped or repeated; rows that repeat an id stand next to each other. An empty table gives no
rows. Native expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..session import shared_dir
from .common import bound, rows_of, unused

LIMIT = 1 << 16  # slots that are worked out one by one in one part
TASKS = 4096  # for the parts, at most
FOLD = 256  # of them at a time, so that the list of all is copied once for so many
PRECISION = 1 << 26  # steps of the largest weight
BLOCK = 8  # documents in a block
SLICE_ROWS = 20_000  # documents of a source in one slice of the hash range, on average


def whole_weights(weights: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``source``, ``w``: positive whole weights, none of which is left without a slot within the limit.

    ``weights`` has one row per source and so is small next to the data: its totals are a plain window.
    """
    everything = Window.partitionBy(F.lit(1))
    steps = F.floor(F.col("weight") / F.max("weight").over(everything) * PRECISION + 0.5).cast("bigint")
    exact = weights.filter("weight > 0").select("source", F.greatest(F.lit(1), steps).alias("w"))
    most = 2 * F.greatest(F.lit(limit // 4), F.count(F.lit(1)).over(everything))
    return exact.select("source", F.greatest("w", F.call_function("div", F.sum("w").over(everything) + most - 1, most)).alias("w"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _listed(weights: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row: ``sources`` (``source``, ``w``, ``blocks``) in order, ``total`` weight, and ``last``, the slots until the
    last block of the slowest source is due. No row without sources."""
    known = weights.join(blocks.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
    one = known.agg(
        F.sort_array(F.collect_list(F.struct("source", "w", F.coalesce("blocks", F.lit(0)).alias("blocks")))).alias("sources"),
        F.sum("w").alias("total"), F.count(F.lit(1)).alias("n"),
    ).filter("n > 0")
    due = F.transform("sources", lambda s: F.ceil(s["blocks"] * (F.col("total") / s["w"])).cast("bigint") + 1)
    return one.withColumn("last", F.greatest(F.lit(1), F.array_max(due)))


def _part_slots(n: Column, limit: int) -> Column:
    """How many slots are worked out in one part of the schedule."""
    return F.greatest(F.lit(limit).cast("bigint"), 4 * n)


def _picked(listed: DataFrame) -> DataFrame:
    """``source``, ``blocks``, ``turn``, ``slot`` for the slots from ``first`` to before ``stop`` of every row of ``listed``.

    The work starts at ``start``, where any choice of blocks will do that gives each source its share rounded down
    or up: at ``start`` all of them leave as many released blocks with deadlines up to any slot that is a longest window away,
    and from there earliest deadline first leaves the same ones. So if ``first`` is that far from ``start``, or is 0,
    the picks are those of a schedule worked out from slot 0.
    """
    start = F.col("start")
    # Shares at the start: whole blocks and the rest of the division by the total.
    at = F.transform("sources", lambda s: F.struct(s["w"].alias("w"), _div(start * s["w"], F.col("total")).alias("whole"), (start * s["w"] % F.col("total")).alias("rest")))
    begun = listed.withColumn("at", at).withColumn("extra", (start - F.aggregate("at", F.lit(0).cast("bigint"), lambda n, s: n + s["whole"])).cast("int"))

    def due(s: Column, done: Column) -> Column:
        """Deadline of the next block, in slots from the start: ceil(((done + 1) * total - rest) / w)."""
        return _div((done + 1) * F.col("total") - s["rest"] + s["w"] - 1, s["w"])

    zero = F.lit(0).cast("bigint")
    early = F.array_sort(F.transform("at", lambda s, i: F.struct((s["rest"] == 0).alias("none"), due(s, zero).alias("due"), i.alias("i"))))
    early = F.transform(F.slice(early, 1, F.col("extra")), lambda e: e["i"])
    begun = begun.withColumn("early", early)
    done = F.transform("at", lambda s, i: F.when(F.array_contains("early", i), F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
    begun = begun.withColumn("done", done).withColumn("slots", (F.col("stop") - start).cast("int"))

    def scheduled(sources: Column, total: Column, slots: Column) -> Column:
        indexes = F.sequence(F.lit(0), F.size(sources) - 1)

        def step(state: Column, slot: Column) -> Column:
            done = state["done"]

            def candidate(i: Column) -> Column:
                j, s = F.get(done, i), F.get(sources, i)
                released = j * total < (slot + 1) * s["w"] + s["rest"]  # floor(j * total / w) <= slot, counted from slot 0
                return F.when(released, F.struct(due(s, j).alias("due"), i.alias("i")))

            pick = F.array_min(F.filter(F.transform(indexes, candidate), lambda c: c.isNotNull()))["i"]
            return bound(
                pick,
                lambda p: F.struct(
                    F.transform(done, lambda d, i: d + F.when(i == p, F.lit(1)).otherwise(F.lit(0)).cast("bigint")).alias("done"),
                    F.concat(
                        state["picks"], F.array(F.struct(p.alias("i"), F.get(done, p).alias("turn"), slot.cast("bigint").alias("slot")))
                    ).alias("picks"),
                ),
            )

        none = F.array().cast("array<struct<i:int,turn:bigint,slot:bigint>>")
        begin = F.struct(F.col("done").alias("done"), none.alias("picks"))

        def some(state: Column, at: Column) -> Column:
            part = F.aggregate(
                F.sequence(at, F.least(at + FOLD, slots) - 1), F.struct(state["done"].alias("done"), none.alias("picks")), step
            )
            kept = lambda p: F.filter(p["picks"], lambda x: x["slot"] + F.col("start") >= F.col("first"))
            return bound(part, lambda p: F.struct(p["done"].alias("done"), F.concat(state["picks"], kept(p)).alias("picks")))

        return F.aggregate(F.sequence(F.lit(0), slots - 1, F.lit(FOLD)), begin, some, lambda s: s["picks"])

    picks = begun.select("sources", "at", "start", F.inline(scheduled(F.col("at"), F.col("total"), F.col("slots"))))
    named = F.get("sources", F.col("i"))
    return picks.select(
        named["source"].alias("source"), named["blocks"].alias("blocks"), (F.get("at", F.col("i"))["whole"] + F.col("turn")).alias("turn"),
        (F.col("start") + F.col("slot")).alias("slot"),
    )


def schedule(weights: DataFrame, blocks: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``source``, ``turn`` (0, 1, ... of the source), ``slot``, ``cycle``: the first slots, at most ``limit`` or four times the
    number of sources; ``cycle`` is how many they are.

    ``blocks`` has ``source`` and ``blocks``, how many there are of it.
    """
    zero = F.lit(0).cast("bigint")
    begin = _listed(weights, blocks).withColumn("stop", F.least(F.col("last"), _part_slots(F.col("n"), limit)))
    listed = begin.select("sources", "total", "stop", zero.alias("start"), zero.alias("first"))
    cycle = begin.select(F.col("stop").alias("cycle"))
    return _picked(listed).select("source", "turn", "slot").crossJoin(F.broadcast(cycle))


def whole_schedule(weights: DataFrame, blocks: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``source``, ``turn``, ``slot`` of every block that there is.

    Parts of ``limit`` slots are worked out side by side, each from one longest window before it. So no task
    goes over more than about one and a half times ``limit`` slots, however many there are.
    """
    listed = _listed(weights, blocks).checkpoint()  # one row
    size = listed.select(F.ceil(F.col("last") / _part_slots(F.col("n"), limit)).alias("parts")).first()
    parts = weights.sparkSession.range(0, size.parts if size else 0, 1, max(1, min(size.parts if size else 1, TASKS)))
    slots = _part_slots(F.col("n"), limit)
    window = F.array_max(F.transform("sources", lambda s: _div(F.col("total") + s["w"] - 1, s["w"]))) + 1
    spread = parts.crossJoin(F.broadcast(listed)).withColumn("first", F.col("id") * slots)
    spread = spread.withColumn("start", F.greatest(F.lit(0), F.col("first") - window)).withColumn("stop", F.least(F.col("last"), F.col("first") + slots))
    return _picked(spread.select("sources", "total", "start", "first", "stop")).filter("turn < blocks").drop("blocks")


def damped_weights(docs: DataFrame, source_col: str, power: float = 0.7) -> DataFrame:
    """``source``, ``weight``: the number of all documents of each source, to a power below 1."""
    counts = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("source", F.pow("n", F.lit(power)).alias("weight"))


def given_weights(spark, weights: Mapping[str, float]) -> DataFrame:
    """``source``, ``weight`` from a mapping."""
    return rows_of(spark, [(s, float(w)) for s, w in weights.items()], ["source", "weight"])


def numbered(docs: DataFrame, id_col: str, source_col: str, seed: str, out: str) -> DataFrame:
    """Add ``out``: 0, 1, ... per source in the order of the seeded hash."""
    key, digest, part, size = (unused(docs, c) for c in ("_source", "_digest", "_slice", "_n"))
    named = docs.withColumn(key, _key(source_col)).withColumn(
        digest, F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    )
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    totals = named.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / float(SLICE_ROWS)).cast("bigint").alias(size))
    sliced = spread_join(named, totals, [key]).withColumn(part, F.shiftright(share * F.col(size), 32))
    counts = sliced.groupBy(key, part).agg(F.count(F.lit(1)).alias(size))
    earlier = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, part, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(out))
    within = Window.partitionBy(key, part).orderBy(digest, F.col(id_col))
    placed = sliced.drop(size).withColumn(size, F.row_number().over(within) - 1)
    joined = placed.join(offsets, [key, part])
    return joined.select(*docs.columns, (F.col(out) + F.col(size)).cast("bigint").alias(out))


def _key(source_col: str) -> Column:
    """The source as a join key that is never NULL."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("-"))


def mix(
    docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", source_col: str = "source",
    block: int = BLOCK, limit: int = LIMIT, seed: str = "mix", out: str = "mix",
) -> DataFrame:
    """Add the struct ``out``: ``block`` (number within the source), ``slot`` and ``place`` in the block.

    Sorting by slot and place gives the mixed order.
    """
    shared_dir(docs.sparkSession)
    key, place, time, number = (unused(docs, c) for c in ("_source", "_position", "_slot", "_block"))
    given = weights.select(F.col("source").cast("string").alias("source"), F.col("weight").cast("double").alias("weight"))
    counts = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.ceil(F.count(F.lit(1)) / float(block)).cast("bigint").alias("blocks"))
    planned = whole_schedule(whole_weights(given, limit), counts, limit).checkpoint()
    timed = planned.select(_key("source").alias(key), F.col("turn").alias(number), F.col("slot").alias(time))
    placed = numbered(docs, id_col, source_col, seed, place).withColumn(key, _key(source_col))
    placed = placed.withColumn(number, _div(F.col(place), F.lit(block).cast("bigint")))
    found = spread_join(placed, timed, [key, number])
    return found.select(
        *[F.col(c) for c in docs.columns if c != out],
        F.struct(
            F.col(number).alias("block"),
            F.col(time).alias("slot"),
            (F.col(place) % block).cast("int").alias("place"),
        ).alias(out),
    )


def in_mixed_order(mixed: DataFrame, out: str = "mix") -> DataFrame:
    """The documents in the order of their slots, in consecutive partitions, without ``out``."""
    order = [F.asc_nulls_last(f"{out}.slot"), F.asc(f"{out}.place")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).drop(out)
