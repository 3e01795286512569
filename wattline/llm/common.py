"""What the operators of this subpackage share: table reading, word rules, lineage cuts, connected components."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.streaming.storage import shared_dir

#: Fixed by the contracts: A-Z are lower-cased, then a word is a run of characters outside this class.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: The same on texts that keep their case.
OUTSIDE, INSIDE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, f"{SEPARATORS}+"), "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda that names an expression would compute it again for every element; a lambda's own variable is computed
    once, so the value is bound as the only element of an array.
    """
    return F.transform(F.array(value), body)[0]


def whole(docs: DataFrame, *but: str) -> Column:
    """All columns of the rows but the named as one struct ``row``, so that no name of theirs meets an operator's own."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns if name not in but]).alias("row")


def column(name: str) -> Column:
    """The column of just that name, dots and all."""
    return F.col(f"`{name}`")


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept for measuring: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def cut(frame: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder and read from there, so that its lineage ends."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(frame.sparkSession))
    return frame.checkpoint()


def sized_broadcast(frame: DataFrame, rows: int, bound: int) -> DataFrame:
    """A broadcast hint if the counted rows are within the bound; beyond it Spark shuffles both sides."""
    return F.broadcast(frame) if rows <= bound else frame


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: ``(a, b)`` long pairs to ``(node, root)``, root the least node.

    Alternates the large-star and small-star steps: each is one aggregation and one join on the edges, the number of
    edges never grows, and the rounds are logarithmic in the diameter. Every round is checkpointed. Nodes without an
    edge to another node are not returned. Hot nodes are safe: minima combine before the shuffle, and the join is one
    that adaptive execution splits. Null ends are dropped.
    """
    links = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        # large star: everything larger than a node is linked to the least of its neighbourhood
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: a node and its smaller neighbours are linked to the least of them
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        links = cut(small.where("a <> b").distinct())
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int, extra: tuple[str, ...] = ()):
    """Documents to fit a classifier on, and how many labels there are of either class.

    Only labels outside the held-out part count. Of each class at most ``per_class`` ids are taken, in the order of a
    hash, which is the documented bound of what the driver receives: rows ``(doc_id, label, text, *extra)``. Several
    labels of one id count as the greatest; several texts of one id as the least. Null ids and null labels are left
    out.
    """
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max(target) > 0).cast("int").alias("label"))
    )
    counts = {row["label"]: row["count"] for row in marks.groupBy("label").count().collect()}
    chosen = reduce(
        DataFrame.unionByName,
        [marks.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)],
    )
    taken = docs.select("doc_id", "text", *extra).join(F.broadcast(chosen), "doc_id")
    taken = taken.groupBy("doc_id", "label").agg(*[F.min(name).alias(name) for name in ("text", *extra)])
    rows = sorted(taken.collect(), key=lambda row: row.doc_id)
    return rows, (counts.get(0, 0), counts.get(1, 0))
