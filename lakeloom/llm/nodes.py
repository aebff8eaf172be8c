"""Sets of words as nodes of a link graph: one per different set, named by the smallest id that has it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import small_ones, spread_join
from ..operators.ordering import dense_key
from ..sources.writers import staged

ID_BYTES = 10 << 20  # ids up to this size are sent to every executor


def text_hash(text: str) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(text)


@dataclass
class Nodes:
    """``sets`` has class, id, th (hash of the text) and node of every different set; ``further`` those of
    them that share their id with another set and so have a number above all ids."""

    named: DataFrame  # id, th, text of all rows
    sets: DataFrame
    further: DataFrame | None
    last: Column  # the largest id
    changed: DataFrame  # rows that are copies or renumbered

    @staticmethod
    def of(named: DataFrame, members: DataFrame) -> Nodes:
        """``named`` has id, th and text; ``members`` id, th and class, without NULL ids and empty sets."""
        members = members.select("id", "th", "class").distinct()
        lowest = members.groupBy("class").agg(F.min("id").alias("id"))
        firsts = members.join(lowest, ["class", "id"]).groupBy("class", "id").agg(F.min("th").alias("th"))
        ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("th", "class")))
        further = ranked.filter("rank > 1").select("id", "th", "class").checkpoint()
        last = members.agg(F.max("id")).scalar()
        if further.isEmpty():
            further, sets = None, firsts.select("class", "id", "th", F.col("id").alias("node"))
        else:
            above = members.agg(F.max("id") + 1).scalar()
            further = dense_key(further, ["id", "th", "class"], "node", above).checkpoint()
            sets = ranked.filter("rank = 1").select("class", "id", "th", F.col("id").alias("node"))
            sets = sets.unionByName(further.select("class", "id", "th", "node"))
        sets = staged(sets, "sets")
        changed = members.join(sets.select("id", "th", "node"), ["id", "th"], "left").filter("node IS NULL OR node <> id")
        changed = changed.select("id", "th", F.coalesce("node", "id").alias("node"), F.col("node").isNull().alias("copy")).checkpoint()
        return Nodes(named, sets, further, last, changed)

    def rows(self) -> DataFrame:
        """``node`` and ``text`` of every set; a repeated row comes more than once."""
        known = spread_join(self.named.filter("id IS NOT NULL"), self.changed, ["id", "th"])
        return known.filter("copy IS NULL OR NOT copy").select(F.coalesce("node", "id").alias("node"), "text")

    def texts(self, ids: DataFrame) -> DataFrame:
        """``node`` and ``text`` of the nodes in ``ids (node)``, each once; the ids are broadcast where they are measured to be small."""
        (small,) = small_ones([ids], ID_BYTES)
        return self.rows().join(F.broadcast(ids) if small else ids, "node", "left_semi").dropDuplicates(["node"])

    def components(self, labels: DataFrame) -> DataFrame:
        """``class``, ``node``, ``root`` (of the links) and ``component``, the smallest id that it reaches."""
        placed = self.sets.select("class", "id", "th", "node").join(labels, "node", "left")
        placed = placed.select("class", "id", "th", "node", F.coalesce("root", "node").alias("root"))
        if self.further is None:
            return placed.withColumn("component", F.col("root"))
        # A component may reach a smaller id through a further set of that id.
        through = self.further.join(labels, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("id").alias("least"))
        own = F.when(F.col("root") <= self.last, F.col("root"))
        return spread_join(placed, through, ["root"]).withColumn("component", F.least(own, "least")).drop("least")
