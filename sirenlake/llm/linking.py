"""Components of items that meet in bands, without ever emitting all pairs of a band."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sirenlake.functions.session import cut_lineage

from .common import connected_components

SMALL = 16  # bands of up to so many items compare all their pairs at once
LEADERS = 16  # items of a larger band that are compared with all others in the first round
GROWTH = 16  # times as many leaders each round


def shared_bands(banded: DataFrame) -> DataFrame:
    """Items (``id``, ``size``, ``mark``) of every ``band`` with at least two, and its size ``n``."""
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")  # numbers alone, as a least struct would sort all rows
    return cut_lineage(banded.join(shared, "band").select("band", "id", "size", "mark", "n"))


def _components_of(items: DataFrame, components: DataFrame, name: str, new: str) -> DataFrame:
    """Add the component of the column ``name`` (itself if it has no link)."""
    of = components.select(F.col("id").alias(name), F.col("component_id").alias(new))
    return items.join(of, name, "left").withColumn(new, F.coalesce(new, name))


def _joined(components: DataFrame, edges: DataFrame) -> DataFrame:
    """``components`` after more edges; only components that these connect are looked at again."""
    ends = _components_of(_components_of(edges, components, "a", "x"), components, "b", "y")
    moved = connected_components(ends.select("x", "y"), "x", "y")
    top = moved.select(F.col("id").alias("component_id"), F.col("component_id").alias("top"))
    old = components.join(top, "component_id", "left").select("id", F.coalesce("top", "component_id").alias("component_id"))
    return cut_lineage(old.union(moved.join(components, "id", "left_anti")))


def link(
    members: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    near: Column,
    refine: Callable[[DataFrame], DataFrame] | None = None,
    refined_near: Column | None = None,
) -> DataFrame:
    """``id`` and ``component_id`` of every linked item among ``members`` of ``shared_bands``.

    ``near`` may reject a pair by ``size``, ``mark``, ``other_size`` and ``other_mark``; ``confirm`` returns
    those of the pairs (a, b) that link. ``refined_near`` takes the place of ``near`` in refined bands and may use
    the other columns that ``refine`` adds, again with ``other_`` before the name for the second item.

    First, bands of up to SMALL items compare all their pairs and are done; items of larger bands are
    compared with the band's first item. Bands in which all are then in one component are done, too.
    ``refine`` may give the items of the others (``band``, ``id``, ``size``, ``mark``) new bands in which all their links still meet.
    Further rounds compare only items of different components: small bands all of them, larger ones their
    leaders with all others, LEADERS at first, GROWTH times as many each round. The first leaders are those with the lowest
    mark (few rarer words, so near to many), the next ones those of the smallest components. Leaders then leave
    the band, so rounds end for every band and no pair of different components is left out, while a large group of copies costs about one comparison per item.
    """
    pair = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    other = (F.col("id").alias("b"), F.col("size").alias("other_size"), F.col("mark").alias("other_mark"))
    small, large = members.where(F.col("n") <= SMALL), members.where(F.col("n") > SMALL)
    in_small = small.withColumnRenamed("id", "a").join(small.select("band", *other), "band").where((F.col("a") < F.col("b")) & near).select("a", "b")
    firsts = large.groupBy("band").agg(F.min(F.struct("id", "size", "mark")).alias("first"))
    large = cut_lineage(large.join(firsts, "band"))
    star = large.select(F.col("id").alias("a"), "size", "mark", F.col("first.id").alias("b"), F.col("first.size").alias("other_size"), F.col("first.mark").alias("other_mark"))
    in_large = star.where((F.col("a") != F.col("b")) & near).select(*pair)
    edges = cut_lineage(confirm(cut_lineage(in_small.union(in_large).distinct())))
    components = connected_components(edges)

    spokes = large.select("id", F.col("first.id").alias("lead")).where("id != lead").distinct()
    unsettled = _components_of(_components_of(spokes, components, "id", "x"), components, "lead", "y").where("x != y").select("id", "lead")
    open_bands = large.withColumn("lead", F.col("first.id")).join(unsettled, ["id", "lead"], "left_semi").select("band").distinct()
    members = cut_lineage(large.join(open_bands, "band", "left_semi").select("band", "id", "size", "mark"))
    if refine is not None:
        members = refine(members)
        near = near if refined_near is None else refined_near
    given = [c for c in members.columns if c not in ("band", "id")]
    members = _components_of(members, components, "id", "component")

    apart = (F.col("a") != F.col("b")) & (F.col("component") != F.col("other")) & near
    other = ("band", F.col("id").alias("b"), *[F.col(c).alias(f"other_{c}") for c in given], F.col("component").alias("other"))
    leaders, order = LEADERS, ("mark", "k")
    while True:
        stats = members.groupBy("band").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        members = cut_lineage(members.join(stats.where("low < high").select("band", "n"), "band"))
        if members.isEmpty():
            return components
        small, large = members.where(F.col("n") <= SMALL), members.where(F.col("n") > SMALL)
        of_component = large.groupBy("band", "component").agg(F.count("*").alias("k"))
        turn = F.row_number().over(Window.partitionBy("band").orderBy(*order, "id"))
        lead = cut_lineage(large.join(of_component, ["band", "component"]).withColumn("turn", turn).where(F.col("turn") <= leaders).select(*other))
        in_small = small.withColumnRenamed("id", "a").join(small.select(*other), "band").where(apart & (F.col("a") < F.col("b"))).select(*pair)
        large = large.join(lead.select("band", F.col("b").alias("id"), F.lit(True).alias("leads")), ["band", "id"], "left")
        # two leaders meet once
        once = F.col("leads").isNull() | (F.col("a") < F.col("b"))
        in_large = large.withColumnRenamed("id", "a").join(lead, "band").where(apart & once).select(*pair)
        components = _joined(components, cut_lineage(confirm(cut_lineage(in_small.union(in_large).distinct()))))
        left = large.where("leads IS NULL").drop("n", "component", "leads")
        members = _components_of(left, components, "id", "component")
        leaders, order = leaders * GROWTH, ("k", "mark")
