"""Shards of bounded size by extendible hashing.

Documents are placed by the leading bits of a hash of their id. The directory starts with one
bucket; only buckets over the byte limit split, on one more bit, until every bucket fits. Sizes
of all prefixes come from one aggregation over hashes, not from one pass per split: the sizes of
fine prefixes are added up for every shorter one, and a document's bucket is the shortest prefix that fits.

More bits cannot split rows of one hash. Ids whose rows exceed the limit together, and single
documents over it, are kept out of the directory: they fill overflow shards in the order of their
hash, each below the limit, and a document over half of the limit has one of its own. Only a
single document over the limit is in a shard over the limit.

Cases: a NULL id is hashed as the empty string, a NULL text has no bytes. Repeated rows stay in one
shard unless they overflow. An empty table gives no rows. Other columns and names are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import small_ones
from ..operators.ordering import running_sum
from ..session import shared_dir
from ..sources.writers import gathered
from .common import unused

HASH_BITS = 60
SLACK = 6  # bits by which the first aggregation is finer than evenly filled shards
MORE = 8  # bits added for buckets that this does not split far enough
MAP_BYTES = 10 << 20  # a directory up to this size is sent to every executor


def hash_of(id_col: str) -> Column:
    """60 bits of the MD5 digest of the id."""
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftright(h, HASH_BITS - bits)


def directory(hashes: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """The directory over ``hashes (h, bytes)``, none of which exceeds ``limit`` on its own.

    A list of ``(bits, table)``; ``table`` maps a prefix of that many bits to the ``depth`` of its
    bucket. Prefixes that need more bits are in the next table. There is hardly ever a second one.
    """
    total = hashes.agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint")).first()[0]
    bits = min(HASH_BITS, max(1, total // limit).bit_length() + SLACK)
    known, tables, rest = -1, [], hashes
    while True:
        fine = rest.groupBy(_prefix(F.col("h"), bits).alias("p")).agg(F.sum("bytes").alias("bytes"))
        levels = fine.select("p", "bytes", F.explode(F.sequence(F.lit(known + 1), F.lit(bits))).alias("depth"))
        levels = levels.withColumn("q", F.expr(f"shiftright(p, {bits} - depth)"))
        fits = levels.groupBy("depth", "q").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") <= limit)
        found = levels.select("p", "depth", "q").join(fits.select("depth", "q"), ["depth", "q"])
        table = found.groupBy("p").agg(F.min("depth").alias("depth")).checkpoint()
        tables.append((bits, table))
        rest = rest.withColumn("p", _prefix(F.col("h"), bits)).join(table, "p", "left_anti").drop("p")
        if bits == HASH_BITS or rest.isEmpty():
            return tables
        known, bits = bits, min(HASH_BITS, bits + MORE)


def assign(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", out: str = "shard") -> DataFrame:
    """Add the struct ``out``: ``name``, ``depth`` (-1 for overflow), ``bytes`` of the document.

    A regular shard is named by its bits, an overflow shard by ``o`` or ``l`` (one large document)
    and a number.
    """
    shared_dir(docs.sparkSession)
    h, size, prefix, level, end, one = (unused(docs, c) for c in ("_hash", "_bytes", "_prefix", "_depth", "_end", "_one"))
    sized = docs.withColumn(h, hash_of(id_col)).withColumn(size, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint"))
    hashes = sized.groupBy(F.col(h).alias("h")).agg(F.sum(size).alias("bytes")).checkpoint()
    over = hashes.filter(F.col("bytes") > limit).select(F.col("h").alias(h))
    tables = directory(hashes.filter(F.col("bytes") <= limit), limit)
    spilled = not over.isEmpty()
    placed = sized
    if spilled:
        (small,) = small_ones([over], MAP_BYTES)
        placed = sized.join(F.broadcast(over) if small else over, h, "left_anti")
    depth = F.lit(None).cast("int")
    for bits, table in tables:
        (small,) = small_ones([table], MAP_BYTES)
        named = table.select(F.col("p").alias(prefix), F.col("depth").alias(f"{level}{bits}"))
        placed = placed.withColumn(prefix, _prefix(F.col(h), bits)).join(F.broadcast(named) if small else named, prefix, "left").drop(prefix)
        depth = F.coalesce(depth, F.col(f"{level}{bits}"))
    bits_text = F.substring(F.lpad(F.bin(h), HASH_BITS, "0"), F.lit(1), depth)
    kept = [c for c in docs.columns if c != out]
    regular = placed.select(*kept, F.struct(bits_text.alias("name"), depth.alias("depth"), F.col(size).alias("bytes")).alias(out))
    if not spilled:
        return regular
    # Overflow: starting points in one running order; half the limit per shard, so the last document fits too.
    rows = sized.join(F.broadcast(over) if small else over, h, "left_semi")
    half = max(1, limit // 2)
    little = running_sum(rows.filter(F.col(size) <= half), size, [h, size], end)
    start = F.col(end) - F.col(size)
    number = F.concat(F.lit("o"), F.call_function("div", start, F.lit(half).cast("bigint")))
    large = rows.filter(F.col(size) > half)
    large = running_sum(large.withColumn(one, F.lit(1).cast("bigint")), one, [h, size], end)
    shape = lambda df, name: df.select(*kept, F.struct(name.alias("name"), F.lit(-1).alias("depth"), F.col(size).alias("bytes")).alias(out))
    return regular.unionByName(shape(little, number)).unionByName(shape(large, F.concat(F.lit("l"), F.col(end) - 1)))


def write_shards(assigned: DataFrame, path: str, shard_col: str = "shard") -> None:
    """One folder per shard, named ``shard=...``; a shard's rows come together before the write."""
    name = unused(assigned, "_name")
    named = assigned.withColumn(name, F.col(f"{shard_col}.name")).drop(shard_col).withColumnRenamed(name, "shard")
    gathered(named, "shard").write.partitionBy("shard").parquet(path)
