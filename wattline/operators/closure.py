"""Who is below whom in a topology: the closure of parent and child links.

Batch operators over links of any shape: trees, shared children, cycles. What they find on the way is stored compressed
in the shared folder, and a step's shuffle files go as soon as it is stored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.streaming.storage import delete, run_dir, shuffles_dropped

#: A round is done in slices of its ancestors, one per so many links, so its shuffles take the disk of one slice.
SLICE_LINKS = 4_000_000
#: Pairs of one slice of those ancestors whose pairs are found more than once.
SLICE_PAIRS = 50_000_000
#: Pairs below a device, or ways into it, that are dealt out to several tasks when more; and pairs that a task makes.
LARGE = 50_000
TASK_PAIRS = 2_000_000
#: Ways into what lies below that are told apart for one ancestor; pairs of others are grouped.
MOST_ENTRIES = 64
_PAIRS = "ancestor string, descendant string, depth int, reach int, _slice int"


def descendants(links: DataFrame, parent: str = "device", child: str = "childdevice") -> DataFrame:
    """All ``ancestor, descendant, depth``, the depth being the links of a shortest way down.

    Devices with nothing above them are taken off the top, layer by layer, while that takes away many links. What
    remains, the core, has its pairs found by ``_doubled`` and stored. A device of a layer has its links, those of the
    layers below, and whatever the core has below the devices where its ways enter it. Where these lie in trees, a pair
    belongs to one such entry, so the pairs come out of one join with the core's pairs as they are read, without being
    stored, shuffled or grouped; only where ways meet again are they grouped (``_below_layers``).

    Links from or to null and from a device to itself say nothing, repeated links count once, and ways round a cycle
    end where they come back: no device is below itself.
    """
    spark = links.sparkSession
    folder = run_dir(spark, "closure")
    with shuffles_dropped(spark):
        first = _stored(_named(links, parent, child).where("ancestor <> descendant").distinct(), f"{folder}/links")
        core, layers = _peeled(first, folder)
        pairs = _doubled(core, folder)
        if layers:
            pairs = pairs.unionByName(_below_layers(core, layers, pairs, folder))
        delete(spark, f"{folder}/links")
    return pairs


def _peeled(links: DataFrame, folder: str) -> tuple[DataFrame, list[DataFrame]]:
    """The links without those of devices that nothing is above, and these, again and again while they are a tenth.

    A device of a layer has links to later layers and to what remains, which has none back.
    """
    spark = links.sparkSession
    left, layers, many = links, [], links.count()
    while many:
        under = left.select(F.col("descendant").alias("ancestor"), F.lit(False).alias("_top")).distinct()
        parted = left.join(under, "ancestor", "left").withColumn("_top", F.col("_top").isNull())
        path = f"{folder}/layer-{len(layers)}"
        parted.write.option("compression", "zstd").partitionBy("_top").parquet(path)
        parted = spark.read.schema(parted.schema).parquet(path)
        rest = parted.where("not _top").drop("_top")
        before, many = many, rest.count()
        if 10 * many > 9 * before:
            delete(spark, path)
            break
        layers.append(parted.where("_top").drop("_top"))
        left = rest
    return left, layers


def _doubled(links: DataFrame, folder: str) -> DataFrame:
    """All pairs of the links, stored.

    Path doubling: when all pairs up to ``2^k`` links are known, a pair of up to ``2^(k+1)`` is one of exactly ``2^k``
    followed by a known one, so the rounds are logarithmic in the depth of the topology, and in a tree every new pair
    is made once. A round is, per slice of the ancestors, one join and one aggregation; a device with many links above
    and below is a hot key of that join, which adaptive execution splits. A round stores only its new pairs, and those
    below what may be a middle of the next round: what lies ``2^(k+1)`` below something also lies ``2^k`` below
    something, so they get fewer.
    """
    spark = links.sparkSession
    found = f"{folder}/pairs"
    slices = max(1, -(-links.count() // SLICE_LINKS))
    first = links.withColumn("depth", F.lit(1))
    _add(first.withColumn("_slice", F.pmod(F.xxhash64("ancestor"), F.lit(slices)).cast("int")), found, 1)
    reach, below = 1, None
    while True:
        known = spark.read.schema(_PAIRS).parquet(found)
        newest = known.where(F.col("reach") == reach)
        if newest.isEmpty():
            break
        steps = newest.where(F.col("depth") == reach)
        middles = steps.select(F.col("descendant").alias("ancestor")).distinct()
        more = newest.select("ancestor", "descendant", "depth")
        more = more if below is None else below.unionByName(more)
        below = _stored(more.join(middles, "ancestor", "left_semi"), f"{folder}/below-{reach}")
        delete(spark, f"{folder}/below-{reach // 2}")
        onward = below.select(F.col("ancestor").alias("via"), "descendant", (F.col("depth") + reach).alias("depth"))
        for number in range(slices):
            here = F.col("_slice") == number
            longer = (
                onward.join(steps.where(here).select("ancestor", F.col("descendant").alias("via")), "via")
                .where("ancestor <> descendant")
                .groupBy("ancestor", "descendant")
                .agg(F.min("depth").alias("depth"))
                .join(known.where(here).select("ancestor", "descendant"), ["ancestor", "descendant"], "left_anti")
            )
            _add(longer.withColumn("_slice", F.lit(number)), found, 2 * reach)
        reach *= 2
    delete(spark, f"{folder}/below-{reach // 2}")
    return known.select("ancestor", "descendant", "depth")


def _below_layers(core: DataFrame, layers: list[DataFrame], pairs: DataFrame, folder: str) -> DataFrame:
    """The pairs of the layers' devices, to each other and to the core with its ``pairs``.

    The devices of the core that a device reaches by links of layers are its entries. Two entries with trees below
    them (``_labels``) have something below in common only if one is below the other, and by their positions that is
    seen from one entry to the next. An inner entry that is no nearer by its own way than through the outer one is left
    out; else what is at and below it is a hole in the outer one's tree, an interval of positions. So every pair comes
    of one entry. Devices with more than ``MOST_ENTRIES``, or with entries that are no trees, have their pairs grouped.
    """
    spark = core.sparkSession
    labels = _labels(core, pairs, folder)
    reached = _through_layers(layers, folder)
    many = reached.groupBy("ancestor").agg(F.count("*").alias("_ways")).where(F.col("_ways") > MOST_ENTRIES)
    many = _stored(many.select("ancestor", F.lit(True).alias("_many")), f"{folder}/many")
    marked = reached.join(labels.withColumnRenamed("node", "descendant"), "descendant", "left")
    marked = marked.join(many, "ancestor", "left").select(
        "ancestor",
        "descendant",
        "depth",
        _or_0("size").alias("size"),
        F.coalesce("tree", F.lit(True)).alias("_tree"),
        F.coalesce("root", "descendant").alias("root"),
        _or_0("pos").alias("pos"),
        (F.col("depth") - F.coalesce("level", F.lit(0))).alias("up"),
        F.coalesce("_many", F.lit(False)).alias("_many"),
        F.when(F.col("_many"), F.xxhash64("descendant")).alias("_spread"),
    )
    own = Window.partitionBy("ancestor", "_spread")
    last = F.lag(F.struct("root", (F.col("pos") + F.col("size")).alias("pos"))).over(own.orderBy("root", "pos"))
    seen = marked.withColumn("_last", last)
    seen = seen.withColumn("_met", F.expr("coalesce(_last.root = root and _last.pos >= pos, false)"))
    own_ways = {"_met": F.max("_met").over(own), "_tree": F.min("_tree").over(own), "_ways": F.count("*").over(own)}
    grouped = F.col("_many") | ~F.col("_tree") & (F.col("_ways") > 1)
    place = F.when(~grouped & F.col("_met"), F.struct("root", "pos", "up")).alias("place")
    seen = seen.withColumns(own_ways)
    seen = seen.select("ancestor", "descendant", "depth", "size", grouped.alias("grouped"), place)
    entries = _stored(seen, f"{folder}/entries")
    for name in ("many", *(f"reached-{number}" for number in range(len(layers) - 1))):
        delete(spark, f"{folder}/{name}")

    met = entries.where("place is not null")
    met = met.select("ancestor", F.struct("descendant", "depth", "size", "place.*").alias("_x"))
    met = met.groupBy("ancestor").agg(F.collect_list("_x").alias("_all")).withColumn("_kept", F.expr(_KEPT))
    met = _stored(met.select("ancestor", F.inline(F.expr(_WITH_HOLES))), f"{folder}/met")
    columns = ["ancestor", "descendant", "depth", "size"]
    whole = entries.where("place is null and not grouped").select(columns)
    whole = whole.unionByName(met.where("size(holes) = 0").select(columns))
    holed = met.where("size(holes) > 0")
    crowds = _stored(_crowds(entries), f"{folder}/crowds")
    placed = pairs.join(labels.select(F.col("node").alias("descendant"), "pos"), "descendant")
    out = [whole.drop("size"), holed.select("ancestor", "descendant", "depth")]
    if rows := _pairs_below(whole):
        out.append(_onward(pairs, whole, crowds, rows))
    if rows := _pairs_below(holed):
        outside = _onward(placed, holed, crowds, rows, "holes").where(
            "not exists(holes, hole -> pos between hole.pos and hole.pos + hole.size)"
        )
        out.append(outside.drop("pos", "holes"))
    return reduce(DataFrame.unionByName, out + _grouped(pairs, entries.where("grouped"), crowds, folder))


_INSIDE = "({0}.pos > {1}.pos and {0}.pos <= {1}.pos + {1}.size and {0}.root = {1}.root)"
# Entries of a device without those that lie inside another and are no nearer than by it.
_KEPT = f"filter(_all, x -> not exists(_all, y -> {_INSIDE.format('x', 'y')} and y.up <= x.up))"
_WITH_HOLES = f"""
    transform(_kept, x -> named_struct(
        'descendant', x.descendant, 'depth', x.depth, 'size', x.size,
        'holes', transform(filter(_kept, y -> {_INSIDE.format("y", "x")}),
                           y -> named_struct('pos', y.pos, 'size', y.size))))"""


def _pairs_below(entries: DataFrame) -> int:
    return entries.agg(F.sum("size")).first()[0] or 0


def _crowds(entries: DataFrame) -> DataFrame:
    """Entries with much below them, in how many parts that goes; and with many ways in, in how many these go."""
    crowds = entries.where("size > 0").groupBy(F.col("descendant").alias("_via"))
    crowds = crowds.agg(F.max("size").alias("_size"), F.count("*").alias("_ways"))
    number = [(F.floor(F.col(name) / LARGE) + 1).cast("int") for name in ("_size", "_ways")]
    crowds = crowds.where(F.greatest("_size", "_ways") >= LARGE)
    return crowds.select("_via", number[0].alias("_parts"), number[1].alias("_sets"))


def _onward(pairs: DataFrame, entries: DataFrame, crowds: DataFrame, rows: int, *also: str) -> DataFrame:
    """What is below the entries, by the way through them, some ``rows``.

    Of ``crowds`` every part of the pairs meets every set of the ways in, so that one device is not one task's work,
    and what a task holds of the pairs below an entry has a limit.
    """

    def dealt(frame: DataFrame, own: str, others: str, by: str, number: str, each: str) -> DataFrame:
        frame = frame.join(crowds, "_via", "left")
        hashed = F.pmod(F.xxhash64(by), F.coalesce(own, F.lit(1))).cast("int").alias(number)
        every = F.explode(F.sequence(F.lit(0), F.coalesce(others, F.lit(1)) - 1)).alias(each)
        return frame.select("*", hashed, every).drop("_parts", "_sets").repartition(tasks, *keys)

    keys, tasks = ["_via", "_part", "_set"], -(-rows // TASK_PAIRS)
    into = entries.where("size > 0")
    into = into.select("ancestor", F.col("descendant").alias("_via"), F.col("depth").alias("_before"), *also)
    into = dealt(into, "_sets", "_parts", "ancestor", "_set", "_part")
    onward = dealt(pairs.withColumnRenamed("ancestor", "_via"), "_parts", "_sets", "descendant", "_part", "_set")
    both = into.join(onward, keys)
    return both.withColumn("depth", F.col("depth") + F.col("_before")).drop(*keys, "_before")


def _grouped(pairs: DataFrame, entries: DataFrame, crowds: DataFrame, folder: str) -> list[DataFrame]:
    """The pairs of devices whose ways may meet again, the shortest of each, stored; nothing if there are none."""
    spark = pairs.sparkSession
    path = f"{folder}/grouped"
    rows = entries.agg(F.sum(F.col("size") + 1)).first()[0] or 0
    slices = -(-rows // SLICE_PAIRS)
    for number in range(slices):
        here = entries.where(F.pmod(F.xxhash64("ancestor"), F.lit(slices)) == number)
        onward = _onward(pairs, here, crowds, -(-rows // slices))
        found = here.select("ancestor", "descendant", "depth").unionByName(onward)
        found = found.groupBy("ancestor", "descendant").agg(F.min("depth").alias("depth"))
        found.write.mode("append").option("compression", "zstd").parquet(path)
    return [spark.read.schema(found.schema).parquet(path)] if slices else []


def _through_layers(layers: list[DataFrame], folder: str) -> DataFrame:
    """The pairs by links of layers alone: each layer's links, and behind them what the later layers reach."""
    reached = layers[-1].withColumn("depth", F.lit(1))
    for number in reversed(range(len(layers) - 1)):
        links = layers[number]
        onward = reached.select(F.col("ancestor").alias("via"), "descendant", (F.col("depth") + 1).alias("depth"))
        longer = onward.join(links.withColumnRenamed("descendant", "via"), "via").drop("via")
        both = links.withColumn("depth", F.lit(1)).unionByName(longer)
        both = both.groupBy("ancestor", "descendant").agg(F.min("depth").alias("depth"))
        reached = _stored(both, f"{folder}/reached-{number}").unionByName(reached)
    return reached


def _labels(core: DataFrame, pairs: DataFrame, folder: str) -> DataFrame:
    """Every ``node`` of the core, stored: the ``size`` of what is below it, and whether that is a ``tree``.

    That is so if whatever is below has one link into it, and none leads back to the node. What is below a node in such
    a tree then has the positions after its own: ``pos`` to ``pos + size``, within the tree of ``root``; ``level`` is
    the links down from there. Other nodes have none.
    """
    ends = core.selectExpr("stack(2, ancestor, 1L, 0L, descendant, 0L, 1L) as (node, outs, ins)")
    ends = ends.groupBy("node").agg(F.sum("outs").alias("outs"), F.sum("ins").alias("ins"))
    ends = _stored(ends, f"{folder}/ends")
    under = pairs.join(ends.withColumnRenamed("node", "descendant"), "descendant").groupBy("ancestor")
    under = under.agg(F.count("*").alias("size"), F.sum("outs").alias("_outs"), F.sum("ins").alias("_ins"))
    nodes = ends.join(under.withColumnRenamed("ancestor", "node"), "node", "left")
    size = F.coalesce("size", F.lit(0).cast("bigint"))
    tree = (_or_0("_ins") == size) & (F.col("outs") + _or_0("_outs") == size)
    nodes = _stored(nodes.select("node", size.alias("size"), tree.alias("tree")), f"{folder}/nodes")

    trees = nodes.where("tree")
    inner = core.join(trees.select(F.col("node").alias("ancestor")), "ancestor")
    inner = inner.join(trees.select(F.col("node").alias("descendant"), "size"), "descendant")
    sisters = Window.partitionBy("ancestor").orderBy("descendant").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum(F.col("size") + 1).over(sisters)
    inner = inner.select(F.col("descendant").alias("node"), (1 + F.coalesce(before, F.lit(0))).alias("off"))
    trees = _stored(trees.join(inner, "node", "left"), f"{folder}/trees")
    above = pairs.join(trees.select(F.col("node").alias("ancestor"), "off"), "ancestor").groupBy("descendant")
    above = above.agg(
        F.sum("off").alias("_before"),
        F.count("*").cast("int").alias("_level"),
        F.max(F.when(F.col("off").isNull(), F.col("ancestor"))).alias("_root"),
    )
    placed = trees.join(above.withColumnRenamed("descendant", "node"), "node", "left").select(
        "node",
        F.coalesce("_root", "node").alias("root"),
        (_or_0("off") + _or_0("_before")).alias("pos"),
        F.coalesce("_level", F.lit(0)).alias("level"),
    )
    labels = _stored(nodes.join(placed, "node", "left"), f"{folder}/labels")
    for name in ("ends", "nodes", "trees"):
        delete(core.sparkSession, f"{folder}/{name}")
    return labels


def _or_0(column: str) -> Column:
    return F.coalesce(column, F.lit(0).cast("bigint"))


def stored_links(links: DataFrame, parent: str = "device", child: str = "childdevice") -> DataFrame:
    """Each link once, kept in the shared folder for what reads them several times."""
    with shuffles_dropped(links.sparkSession):
        return _stored(links.select(parent, child).distinct(), run_dir(links.sparkSession, "links"))


def ring_candidates(links: DataFrame, parent: str = "device", child: str = "childdevice") -> DataFrame:
    """Links between different devices, without most of those that cannot lie on a cycle.

    On a cycle every device is above something and below something. Links of other devices are left out, again and
    again while that takes away a tenth of them: what then remains are cycles, and ways between them or of great length.
    """
    spark = links.sparkSession
    folder = run_dir(spark, "rings")
    with shuffles_dropped(spark):
        left = links.select(parent, child).where(F.col(parent) != F.col(child)).distinct()
        left = _stored(left, f"{folder}/0")
        number, many = 0, left.count()
        while True:
            above, under = left.select(F.col(parent).alias("_node")), left.select(F.col(child).alias("_node"))
            both = above.distinct().join(under.distinct(), "_node")
            kept = left.join(both, F.col(parent) == F.col("_node"), "left_semi")
            kept = kept.join(both, F.col(child) == F.col("_node"), "left_semi")
            left = _stored(kept, f"{folder}/{number + 1}")
            delete(spark, f"{folder}/{number}")
            before, many, number = many, left.count(), number + 1
            if not many or 10 * many > 9 * before:
                return left


def in_cycles(links: DataFrame, pairs: DataFrame, parent: str = "device", child: str = "childdevice") -> DataFrame:
    """The links that lie on a cycle, ``parent, child``: the child is above its parent as well."""
    back = pairs.select(F.col("ancestor").alias(child), F.col("descendant").alias(parent))
    itself = links.where(F.col(parent) == F.col(child)).select(parent, child)
    return links.select(parent, child).join(back, [parent, child], "left_semi").unionByName(itself).distinct()


def _named(links: DataFrame, parent: str, child: str) -> DataFrame:
    return links.select(F.col(f"`{parent}`").alias("ancestor"), F.col(f"`{child}`").alias("descendant"))


def _stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _add(pairs: DataFrame, path: str, reach: int) -> None:
    rows = pairs.withColumn("reach", F.lit(reach)).write.mode("append").option("compression", "zstd")
    rows.partitionBy("reach", "_slice").parquet(path)
