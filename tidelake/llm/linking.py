"""Groups of linked rows from buckets of candidates, without all pairs of a bucket.

Rows that share a bucket are candidates. Buckets with the same members bring the same pairs, so one of
them stays. First every id is compared with the smallest id that it shares a bucket with (its smallest
star): one pair an id, however large the buckets are. Then the groups found are contracted, and ids are
compared with the stars of their other buckets where those belong to another group. Rows of a bucket that
then belong to one group need no further comparison: any link between them would not change the groups.
What is left are pairs of rows of different groups; they are compared with each other and with all members
of the bucket, and so no link between groups is lost. Every row knows the smallest of its buckets, so a pair
that meets in many of them is told by the first one, not by each. An operator may bring a ``meet`` of its own,
which tells how near the rows of a pair are as well; then each group's nearest pair is verified first, and only
the pairs that still join different groups after that.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.tables import discard, written

#: Buckets of a row, smallest first, that come along to tell a pair once. More or fewer change only the work.
EARLY = 8


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b): the smallest id it is connected with.

    Alternates the large-star and small-star steps of Kiveris et al. (2014) until the edges no longer
    change. Minima are combined in the map tasks; a hub's rows are split by the skew join.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        down = large.where("a <> b").distinct()
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        last, edges = edges, written(small.union(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct())
        discard(last)
        told = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if told == state:
            break
        state = told
    stars = edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
    return stars.union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def shared_buckets(rows: DataFrame) -> DataFrame:
    """(bucket, id, star): rows of buckets with several ids, each once, with the bucket's smallest id.

    One shuffle of ``rows`` (bucket, id); most buckets have one id, and their rows end there. Other columns
    come along.
    """
    here = Window.partitionBy("bucket").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    both = rows.withColumns({"star": F.first("id").over(here), "last": F.last("id").over(here)})
    return both.where("star <> last").drop("last").dropDuplicates(["bucket", "id", "star"])


def distinct_sets(shared: DataFrame) -> DataFrame:
    """One of the buckets of each set of ids, as a written table; sets are told apart by 128 bits and their size."""
    ids = (F.xxhash64("id", F.lit(k)).cast("decimal(38,0)") for k in (0, 1))
    sets = shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *(F.sum(h).alias(f"sum{k}") for k, h in enumerate(ids)))
    kept = sets.groupBy("n", "sum0", "sum1").agg(F.min("bucket").alias("bucket")).select("bucket")
    return written(shared.join(kept, "bucket", "left_semi"))


def with_component(rows: DataFrame, groups: DataFrame, column: str) -> DataFrame:
    """``rows`` with the component of the id in ``column``; an id without a link is its own."""
    named = groups.select(F.col("id").alias(column), F.col("component").alias(f"{column}_component"))
    return rows.join(named, column, "left").withColumn(f"{column}_component", F.coalesce(f"{column}_component", column))


def linked_groups(
    shared: DataFrame,
    facts: DataFrame | None,
    near: Callable[[Column, Column], Column],
    verify: Callable[[DataFrame], DataFrame],
    meet: Callable[[DataFrame], DataFrame] | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """(id, component) of all ids that have a link.

    ``shared`` is a written table of ``distinct_sets`` and ``facts`` has (id, info) of all its ids, or is
    None where ``shared`` itself carries the small ``info``.
    ``near(info, info)`` is a cheap necessary condition; ``verify`` keeps the pairs (a, b) that are linked.
    ``meet`` takes (bucket, star, id, component) of buckets of several groups as a written table and makes a written
    table of the pairs (a, b, a_component, b_component, gap) of rows of different components that share a bucket and
    may be linked, each once; it then takes the place of ``near`` there.
    ``known`` is a written table of links (a, b) found before; they take the place of the first star.
    """
    stars = shared.where("id <> star").select(F.col("star").alias("a"), F.col("id").alias("b"))

    def informed(pairs: DataFrame) -> DataFrame:
        """The pairs that ``near`` lets through."""
        known = pairs.join(told.toDF("a", "a_info"), "a").join(told.toDF("b", "b_info"), "b")
        return known.where(near(F.col("a_info"), F.col("b_info"))).select("a", "b")

    told = facts if facts is not None else written(shared.groupBy("id").agg(F.min("info").alias("info")))
    first = known if known is not None else written(verify(informed(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))))
    groups = written(components(first))
    apart = with_component(with_component(stars.distinct(), groups, "a"), groups, "b").where("a_component <> b_component").select("a", "b")
    links = written(first.union(verify(informed(apart))))
    discard(groups, *([first] if known is None else []))
    groups = written(components(links))
    named = with_component(shared.select("bucket", "id", "star"), groups, "id").withColumnRenamed("id_component", "component")
    # Every row has been compared with its stars, so only the others of a bucket can bring pairs.
    named = named.where("id <> star")
    span = named.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    mixed = named.join(span.select("bucket", "least"), "bucket")
    if meet is not None:
        mixed = written(mixed.select("bucket", "star", "id", "component"))
        pairs = meet(mixed)
        discard(mixed)
        found = nearest_first(groups, pairs, verify)
        discard(pairs)
    else:
        mixed = written(mixed.join(told, "id").select("bucket", "id", "info", "component", (F.col("component") != F.col("least")).alias("other")))
        early = mixed.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("bucket")), 1, EARLY).alias("early"))
        met_by = written(mixed.join(early, "id"))
        late = written(verify(met_in_buckets(met_by, near)))
        discard(met_by, mixed)
        found = written(components(links.union(late)))
        discard(late)
    discard(links, groups, *([told] if facts is None else []))
    return found


def met_in_buckets(met_by: DataFrame, near: Callable[[Column, Column], Column]) -> DataFrame:
    """(a, b): rows of different components that share a bucket and are ``near``."""
    left, right = (met_by.select("bucket", *(F.col(c).alias(f"{side}_{c}") for c in met_by.columns if c != "bucket")) for side in "ba")
    left = left.where("b_other")
    met = (F.col("a_component") != F.col("b_component")) & (~F.col("a_other") | (F.col("a_id") < F.col("b_id")))
    met &= near(F.col("a_info"), F.col("b_info"))
    before = F.array_min(F.array_intersect("a_early", "b_early")) < F.col("bucket")
    met &= ~F.coalesce(before, F.lit(False))
    return left.join(right, "bucket").where(met).select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct()


def nearest_first(groups: DataFrame, pairs: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``groups`` joined by the linked ones of ``pairs``, as a written table.

    Large groups have many linked pairs, and one is enough to join two groups: the pair with the smallest gap of
    every group is verified first, and then all pairs whose groups are still apart.
    """
    def joined(groups: DataFrame, links: DataFrame) -> DataFrame:
        return written(components(groups.toDF("a", "b").union(links)))

    sides = (pairs.select(F.col(f"{side}_component").alias("of"), F.struct("gap", "a", "b").alias("best")) for side in "ab")
    nearest = reduce(DataFrame.union, sides).groupBy("of").agg(F.min("best").alias("best"))
    nearest = written(nearest.select("best.a", "best.b").distinct())
    linked = written(verify(nearest))
    nearer = joined(groups, linked)
    apart = with_component(with_component(pairs.select("a", "b"), nearer, "a"), nearer, "b").where("a_component <> b_component")
    late = written(verify(apart.select("a", "b").join(nearest, ["a", "b"], "left_anti")))
    found = joined(nearer, late)
    discard(nearest, linked, nearer, late)
    return found
