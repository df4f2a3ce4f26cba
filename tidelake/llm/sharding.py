"""Sharding by extendible hashing.

The directory is indexed by leading bits of a key's hash. A bucket that holds more bytes than the limit
splits on the next bit, others don't, so every row's shard is the shortest prefix of its hash whose rows
fit the limit. The directory is found from sums alone: bytes are added up by hash (rows with equal keys
meet in the map tasks), then by prefixes of a depth that gives some sixteen cells a shard, and all
shorter prefixes are sums of those; only cells that are still too large are looked at bit by bit.

Rows of one hash can't be split by bits. If they exceed the limit together they are dealt over numbered
pages (overflow pages), each within the limit. A single row larger than the limit has a page of its own.
``write_shards`` then moves the rows: one folder a shard and page.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.tables import shared_folder, written

SHARD_BYTES = 32 << 20
HASH_BITS = 60


def key_hash(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key as text; of a NULL key, of the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def fitting_depths(cells: DataFrame, lowest: int, highest: int, limit: int) -> DataFrame:
    """``cells`` (cell of ``highest`` bits, bytes) with the least depth from ``lowest`` on that fits, or NULL."""
    shift = "shiftright(cell, cast({} - depth as int))".format(highest)
    deep = cells.withColumn("depth", F.explode(F.sequence(F.lit(lowest), F.lit(highest)))).withColumn("prefix", F.expr(shift))
    fits = deep.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") <= limit)
    found = deep.select("cell", "depth", "prefix").join(fits.select("depth", "prefix"), ["depth", "prefix"])
    return cells.join(found.groupBy("cell").agg(F.min("depth").alias("depth")), "cell", "left")


def directory(sizes: DataFrame, limit: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """(cell, depth) for all used cells of the returned number of bits; depth NULL: split further by ``hash``.

    ``sizes``: hash, bytes; one row a hash.
    """
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bits = min(HASH_BITS, 4 + max(0, math.ceil(math.log2(max(1, total / limit)))))
    cells = sizes.groupBy(F.shiftright("hash", HASH_BITS - bits).alias("cell")).agg(F.sum("bytes").alias("bytes"))
    return fitting_depths(cells, 0, bits, limit).select("cell", "depth"), bits


def assign_shards(rows: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", size: Column | None = None) -> DataFrame:
    """``rows`` with shard (prefix bits as text), depth, page, and row_bytes.

    ``size`` is a row's bytes, by default those of ``text`` (0 for NULL). Every shard and page holds at
    most ``limit`` bytes, but for single rows larger than that. Rows that repeat go to one shard, if need
    be on several pages. An empty table has no shards. Columns of those names give way.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)) if size is None else size
    rows = rows.withColumn("row_bytes", size.cast("long")).drop("shard", "depth", "page")
    names = rows.columns
    rows = rows.withColumn("_hash", key_hash(F.col(key))).withColumn("_row", F.monotonically_increasing_id())
    sizes = written(rows.groupBy(F.col("_hash").alias("hash")).agg(F.sum("row_bytes").alias("bytes")))
    coarse, bits = directory(sizes, limit)
    coarse = written(coarse)
    # Cells that no prefix of that many bits makes small enough: their hashes, bit by bit.
    tight = sizes.join(coarse.where("depth IS NULL").select("cell"), F.shiftright("hash", HASH_BITS - bits) == F.col("cell")).select(F.col("hash").alias("cell"), "bytes")
    fine = fitting_depths(tight, min(bits + 1, HASH_BITS), HASH_BITS, limit).toDF("_same", "_same_bytes", "_fine")
    over = written(fine)
    placed = (
        rows.join(coarse.toDF("_cell", "_depth"), F.shiftright("_hash", HASH_BITS - bits) == F.col("_cell"))
        .join(over, F.col("_hash") == F.col("_same"), "left")
        .withColumn("depth", F.coalesce("_depth", "_fine", F.lit(HASH_BITS)))
        .withColumn("_over", F.coalesce((F.col("_same_bytes") > limit), F.lit(False)))
    )
    path = F.lpad(F.conv(F.col("_hash").cast("string"), 10, 2), HASH_BITS, "0")
    placed = placed.withColumn("shard", F.substr(path, F.lit(1), F.col("depth")))
    names = [*names, "shard", "depth", "page"]
    whole = placed.where("NOT _over").withColumn("page", F.lit(0).cast("long"))
    return whole.select(*names).unionByName(paged(placed.where("_over"), limit).select(*names))


def write_shards(rows: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", size: Column | None = None, path: str | None = None) -> DataFrame:
    """Writes whole rows as Parquet in ``path`` (by default a new shared folder), and returns them as they were written.

    A shard and page is the folder ``shard=<bits>/page=<n>`` with its rows in one file (``_`` stands for the empty
    prefix). Rows of one shard and page meet in one task, which holds at most ``limit`` bytes of each. Columns as those
    of ``assign_shards``.
    """
    placed = assign_shards(rows, limit, key, size)
    path = path or shared_folder(rows.sparkSession)
    named = placed.withColumn("shard", F.when(F.col("shard") == "", "_").otherwise(F.col("shard")))
    named.repartition("shard", "page").write.partitionBy("shard", "page").parquet(path)
    stored = rows.sparkSession.read.schema(placed.schema).parquet(path)
    return stored.withColumn("shard", F.when(F.col("shard") == "_", "").otherwise(F.col("shard"))).select(*placed.columns)


def paged(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of hashes that exceed the limit, dealt over pages within it.

    Each hash is dealt over lanes of about half the limit first, so no task sees more than a few shards'
    worth of rows of one hash; inside a lane rows fill pages in order.
    """
    lanes = F.greatest(F.lit(1), F.ceil(2 * F.col("_same_bytes") / F.lit(limit)))
    dealt = rows.withColumn("_lane", F.pmod(F.xxhash64("_row"), lanes))
    earlier = Window.partitionBy("_hash", "_lane").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    # Pages of half the limit by where a row begins: what begins in one ends within the limit, if its rows
    # are no larger than half; larger rows have a page of their own.
    large = F.col("row_bytes") * 2 > limit
    filled = F.sum(F.when(large, 0).otherwise(F.col("row_bytes"))).over(earlier)
    numbered = F.sum(large.cast("long")).over(earlier)
    page = F.floor(F.coalesce(filled, F.lit(0)) / F.lit(max(1, limit // 2)))
    slot = F.when(large, 2 * F.coalesce(numbered, F.lit(0)) + 1).otherwise(2 * page)
    return dealt.withColumn("page", (slot * lanes + F.col("_lane")).cast("long"))
