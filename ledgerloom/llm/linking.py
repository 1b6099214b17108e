"""Distributed union-find, and links of items that share buckets.

Everything here is DataFrame work. ``components`` alternates the large-star and small-star
steps of Kiveris et al. (2014): each step groups by a node, with partial minima before the
shuffle, and joins two written tables, whose hot nodes adaptive execution splits.

``link_in_buckets`` finds the connected components of the graph whose edges are the pairs
that share a bucket and pass a check, without listing all pairs of a large bucket. In a
round a bucket with few pairs for its rows lists them and is done. Any other deals a pivot,
which is compared with the bucket's members of other components and then leaves it, since all
its pairs there are decided. Then members that can have no new link leave as well: a member stays only where the bucket holds sizes that admit
it outside its own component. Sizes are grouped first, so that this test costs a member one
comparison for each different size and not for each other member. Once the pairs left are
no more than a few for each row of the first round, or the rounds are used up, the rest is listed exactly:
members outside a bucket's largest component with all others. What the callers' marks of two
items refuse is left out in the join of their bucket, before it is a pair. So no bucket is capped and no
component can be lost, and a component of any size is never joined with itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, present

#: Rounds with pivots at most, and pairs for each row up to which a bucket, or all at once, are listed.
ROUNDS = 4
LISTED = 2


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi") % 1_000_000_007)).first()
    return row[0], row[1] or 0


def components(scratch: Scratch, pairs: DataFrame) -> DataFrame:
    """(id, component) of each node of ``pairs`` (a, b), two columns of one type: the smallest node it is joined to.

    Loops and repeated pairs change nothing; pairs with a null are no pairs.
    """
    edges = scratch.cut(pairs.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("m").alias("lo"), F.col("v").alias("hi")).unionByName(least.select(F.col("m").alias("lo"), F.col("u").alias("hi")))
        after = scratch.cut(small.distinct(), "stars")
        scratch.drop(edges)
        edges, was, before = after, before, _state(after)
        if was == before:
            break
    roots = edges.select("lo").distinct().select(F.col("lo").alias("id"), F.col("lo").alias("component"))
    return scratch.cut(edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots), "components")


def _live(held: DataFrame) -> DataFrame:
    """The members of each bucket that it may still link with a member of another component."""
    sizes = held.groupBy("bucket", "n", "most").agg(F.min("component").alias("least_c"), F.max("component").alias("most_c"))
    sizes = sizes.select("bucket", F.col("n").alias("other_n"), F.col("most").alias("other_most"), "least_c", "most_c")
    other = (F.col("least_c") != F.col("component")) | (F.col("most_c") != F.col("component"))
    fits = (F.col("n") <= F.col("other_most")) & (F.col("other_n") <= F.col("most"))
    return held.alias("h").join(sizes.alias("s"), (F.col("h.bucket") == F.col("s.bucket")) & fits & other, "left_semi")


def _dealt(live: DataFrame, buckets: DataFrame, near: Callable[[str, str], str]) -> DataFrame:
    """Pairs of each bucket's pivot with the members of other components."""
    held = buckets.select(F.col("bucket").alias("_bucket"), "pivot")
    met = live.join(held, F.expr(f"bucket = _bucket AND component <> pivot.component AND n <= pivot.most AND pivot.n <= most AND {near('', 'pivot.')}"))
    return met.select(F.least("id", "pivot.id").alias("a"), F.greatest("id", "pivot.id").alias("b"))


def _listed(live: DataFrame, buckets: DataFrame, near: Callable[[str, str], str], marks: Sequence[str]) -> DataFrame:
    """All pairs of each bucket between different components: those outside the largest with all others."""
    main = buckets.select("bucket", F.col("largest.component").alias("main"))
    one = live.join(main, "bucket").filter("component <> main").select("bucket", "main", *(F.col(c).alias(f"x_{c}") for c in ("id", "n", "most", "component", *marks)))
    two = live.select(F.col("bucket").alias("y_bucket"), *(F.col(c).alias(f"y_{c}") for c in ("id", "n", "most", "component", *marks)))
    fits = f"bucket = y_bucket AND x_component <> y_component AND x_n <= y_most AND y_n <= x_most AND (y_component = main OR x_id < y_id) AND {near('x_', 'y_')}"
    return one.join(two, F.expr(fits)).select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b"))


def _buckets(scratch: Scratch, live: DataFrame, k: int, alone: bool, marks: Sequence[str]) -> tuple[DataFrame, int, float]:
    """Buckets of two components or more with their largest one and a pivot; their rows, and pairs between components.

    ``alone``: no two rows of a bucket have a component in common, so that they need no grouping by it.
    """
    first = F.struct(-F.col("weight"), F.xxhash64("id", F.lit(k)), "id", "n", "most", "component", *marks)
    if alone:
        classes = live.select("bucket", "component", F.lit(1).cast("long").alias("s"), first.alias("pivot"))
    else:
        classes = live.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("s"), F.min(first).alias("pivot"))
    buckets = classes.groupBy("bucket").agg(F.sum("s").alias("size"), F.sum(F.col("s") * F.col("s")).alias("squares"), F.max(F.struct("s", "component")).alias("largest"), F.min("pivot").alias("pivot"))
    buckets = scratch.cut(buckets.filter("size * size > squares"), "buckets")
    return buckets, *buckets.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum(F.expr("(CAST(size AS double) * size - squares) / 2")), F.lit(0.0))).first()


def link_in_buckets(scratch: Scratch, rows: DataFrame, verify: Callable[[DataFrame], DataFrame], again: Callable[[DataFrame], DataFrame] | None = None, rounds: int = ROUNDS, listed: int = LISTED, tested: int | None = None, marks: Sequence[str] = (), near: Callable[[str, str], str] | None = None) -> DataFrame:
    """(id, component) of the ids of ``rows`` (bucket, id, n, most, weight) that have a link, as a written table.

    ``n`` is an item's size and ``most`` the largest size of an item that it can be linked
    with through this bucket; a pair is a candidate where both admit each other in a bucket.
    An item is in a bucket once. The heaviest item of a bucket is its first pivot: what has
    many copies is likely what the others of a group of near copies were made from.
    ``verify`` takes pairs (a, b) of ids, each once, and returns those that are links, as a
    written table. ``again`` takes the items (id, weight) that are undecided after the first
    pivots and returns other rows for them, in which all their candidates meet: an index that
    is too dear for all items, but tells more of fewer.

    ``marks`` are further columns of ``rows``, the same in all rows of an item, and ``near``
    makes of two prefixes of column names the condition that two items' marks have to meet to
    be a candidate: what it refuses is never made a row. It must hold for all links. Where the
    marks that ``again`` gives refuse most pairs, ``tested`` pairs for each row of the first
    round, and not ``listed``, are few enough to list them all.
    """
    labels, near = None, near or (lambda x, y: "true")
    live = rows.withColumn("component", F.col("id"))

    def narrowed(rows: DataFrame) -> DataFrame:
        held = scratch.cut(rows.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")), "labelled")
        left = scratch.cut(_live(held), "live")
        scratch.drop(held)
        return left

    for k in range(rounds + 1):
        if labels is not None:
            before, live = live, narrowed(live.drop("component"))
            scratch.drop(before)
        buckets, size, pairs_left = _buckets(scratch, live, k, labels is None, marks)
        most = size * listed if labels is None else most
        if k and again is not None and pairs_left > most:
            scratch.drop(buckets)
            before, live = live, narrowed(again(scratch.cut(live.groupBy("id").agg(F.max("weight").alias("weight"), *(F.max(c).alias(c) for c in marks)), "items")))
            scratch.drop(before)
            again, most = None, most // listed * (tested or listed)
            buckets, size, pairs_left = _buckets(scratch, live, k, False, marks)
        if not size:
            scratch.drop(buckets)
            break
        last = k == rounds or pairs_left <= most
        small = F.expr(f"CAST(size AS double) * size - squares <= {2 * listed} * size")
        if last:
            pairs = _listed(live, buckets, near, marks)
        else:
            large = buckets.filter(~small)
            pairs = _listed(live, buckets.filter(small), near, marks).unionByName(_dealt(present(live, "bucket", large.select("bucket")), large, near))
        links = verify(pairs.distinct())
        edges = links if labels is None else links.unionByName(labels.select(F.col("id").alias("a"), F.col("component").alias("b")))
        was, labels = labels, components(scratch, edges)
        scratch.drop(links, *([was] if was is not None else []))
        if last:
            scratch.drop(buckets)
            break
        left = present(live, "bucket", large.select("bucket")).join(large.select("bucket", F.col("pivot.id").alias("_pivot")), "bucket")
        live = scratch.cut(left.filter("id <> _pivot").drop("_pivot"), "undecided")
        scratch.drop(buckets)
    if labels is None:
        labels = scratch.cut(rows.select("id", F.col("id").alias("component")).limit(0), "components")
    return labels


def by_exact_rarity(scratch: Scratch, held: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """Rows for ``link_in_buckets`` in which all pairs of ``items`` (id, weight, marks) with a Jaccard similarity of ``percent`` meet.

    ``held`` (id, shingles) is a written table of their sets. Shingles are ordered by the
    number of these items that have them; those of one item alone come first and make no
    bucket, so that items with too much of their own meet nobody.
    """
    each = held.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("bucket"))
    common = scratch.cut(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1"), "common")
    ranked = each.join(common, "bucket").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("nodes", "bucket"))).alias("common"))  # of one item
    ranked = ranked.withColumn("own", F.col("n") - F.size("common"))
    first = F.expr(f"slice(common, 1, greatest(0, n - (n * {percent} + 99) div 100 + 1 - own))")
    placed = ranked.select("id", "n", "own", F.posexplode(first).alias("at", "shingle"))
    most = F.expr(f"CAST({100 + percent} * (n - own - at) div {percent} - n AS bigint)")
    out = placed.select(F.col("shingle.bucket").alias("bucket"), "id", F.col("n").cast("long").alias("n"), most.alias("most")).join(items, "id")
    out = scratch.cut(out.select("bucket", "id", "n", "most", *(c for c in items.columns if c != "id")), "met-again")
    scratch.drop(held, common)
    return out
