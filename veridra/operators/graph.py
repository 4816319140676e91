"""Graph operators over node and edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch, stored


def closure(edges: DataFrame, child: str, parent: str, most_hops: int = 10_000) -> DataFrame:
    """(node, ancestor, hops): every ancestor of a node with its least distance, itself at 0.

    Known paths are joined to known paths, so the reach doubles each round and a hierarchy of
    any depth ends after log2(depth) rounds; a round that adds and shortens nothing is
    the last. Rounds are written to the scratch folder, so the plan does not grow. A hierarchy that is not
    settled at most_hops raises an error.
    """
    up = edges.where(F.col(child).isNotNull() & F.col(parent).isNotNull() & (F.col(child) != F.col(parent)))
    up = up.select(F.col(child).alias("_c"), F.col(parent).alias("_p")).distinct()
    nodes = up.select(F.col("_c").alias("node")).union(up.select("_p")).distinct()
    known = stored(
        nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("hops"))
        .unionByName(up.select(F.col("_c").alias("node"), F.col("_p").alias("ancestor"), F.lit(1).alias("hops")))
    )
    reach, size = 1, known.agg(F.count("*"), F.sum("hops")).first()
    while True:
        on = known.where("hops > 0").select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_a"), F.col("hops").alias("_h"))
        # a path of up to 2 x reach hops is one of exactly `reach` hops and one more, or is known
        longer = known.where(F.col("hops") == reach).join(on, "ancestor").select("node", F.col("_a").alias("ancestor"), (F.col("hops") + F.col("_h")).alias("hops"))
        wider = stored(known.unionByName(longer).groupBy("node", "ancestor").agg(F.min("hops").alias("hops")))
        now = wider.agg(F.count("*"), F.sum("hops")).first()
        if now == size:
            return known
        known, size, reach = wider, now, reach * 2
        if reach > most_hops:
            raise RuntimeError(f"the hierarchy did not settle within {most_hops} hops")


def descendants(edges: DataFrame, child: str, parent: str, roots: DataFrame) -> DataFrame:
    """(node): the roots (one column) and all that is below them, however deep; each round's new nodes are written.

    Only what hangs below the roots is ever joined: no closure of the whole hierarchy. Circles end.
    """
    down = edges.select(F.col(parent).alias("_p"), F.col(child).alias("node")).where("_p IS NOT NULL AND node IS NOT NULL")
    seen = front = stored(roots.select(F.col(roots.columns[0]).alias("node")).distinct())
    while front.head(1):
        below = down.join(front.withColumnRenamed("node", "_p"), "_p").select("node").distinct()
        front = stored(below.join(seen, "node", "left_anti"))
        seen = seen.unionByName(front)
    return seen


#: Buckets of a store of neighbours.
BUCKETS = 128


def _bucket(node: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(buckets)).cast("int").alias("bucket")


def adjacency(edges: DataFrame, src: str, dst: str, kind: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, node, other, kind, ahead): every edge from both its ends, stored in buckets of the node, each sorted by it.

    What reads the neighbours of some nodes reads their buckets only. Edges that repeat stay repeated.
    """
    end = lambda a, b, ahead: F.struct(F.col(a).alias("node"), F.col(b).alias("other"), F.col(kind).alias("kind"), F.lit(ahead).alias("ahead"))
    both = edges.select(F.inline(F.array(end(src, dst, True), end(dst, src, False))))
    path = scratch(edges.sparkSession)
    dealt = both.withColumn("bucket", _bucket("node", buckets)).repartition("bucket").sortWithinPartitions("bucket", "node")
    dealt.write.partitionBy("bucket").parquet(path)
    return edges.sparkSession.read.schema("node string, other string, kind string, ahead boolean, bucket int").parquet(path)


def neighbours(store: DataFrame, nodes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The store's rows of some nodes (node): only their buckets are read."""
    wanted = nodes.select("node", _bucket("node", buckets))
    # at most one number a bucket
    some = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]
    return store.where(F.col("bucket").isin(some)).join(wanted, ["bucket", "node"], "left_semi")


def subgraph(store: DataFrame, starts: DataFrame, hops: int, buckets: int = BUCKETS) -> DataFrame:
    """(node, hop): nodes within `hops` undirected steps of the starts, with the least hop; store is an adjacency.

    Each round's new nodes are written, so a round reads the front and its buckets and repeats nothing before it.
    """
    seen = stored(starts.select(F.col(starts.columns[0]).alias("node")).distinct().withColumn("hop", F.lit(0)))
    front = seen
    for hop in range(1, hops + 1):
        reached = neighbours(store, front, buckets).select(F.col("other").alias("node")).distinct()
        front = stored(reached.join(seen, "node", "left_anti").withColumn("hop", F.lit(hop)))
        seen = seen.unionByName(front)
    return seen


def induced(store: DataFrame, nodes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(src, dst, type): edges of an adjacency with both ends among the nodes, once each."""
    out = neighbours(store, nodes, buckets).where("ahead").select(F.col("node").alias("src"), F.col("other").alias("dst"), F.col("kind").alias("type"))
    return out.join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst", "type").distinct()


def degrees(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, degree) over both directions; a self edge counts twice."""
    ends = edges.select(F.col(src).alias("node")).union(edges.select(F.col(dst)))
    return ends.groupBy("node").agg(F.count("*").alias("degree"))


def contract(ab: DataFrame, bc: DataFrame, a: str, b: str, c: str) -> DataFrame:
    """Edges a-c for every path a-b-c, once each."""
    return ab.join(bc, b).select(a, c).distinct()


def reconcile(edges: DataFrame, nodes: DataFrame, src: str, dst: str, node: str) -> DataFrame:
    """One row of counts: edges, and those whose ends are missing among the nodes."""
    sides = F.array(F.struct(F.col(src).alias("_n"), F.lit(1).alias("_s"), F.lit(0).alias("_d")), F.struct(F.col(dst).alias("_n"), F.lit(0).alias("_s"), F.lit(1).alias("_d")))
    # ends are counted before they meet the nodes: edges do not move
    ends = edges.select(F.inline(sides)).groupBy("_n").agg(F.sum("_s").alias("_s"), F.sum("_d").alias("_d"))
    there = nodes.select(F.col(node).alias("_n")).distinct().withColumn("_there", F.lit(True))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    none = F.col("_there").isNull()
    return ends.join(there, "_n", "left").agg(total("_s").alias("edges"), total(F.when(none, F.col("_s"))).alias("missing_src"), total(F.when(none, F.col("_d"))).alias("missing_dst"))


def ends(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node) of all that edges touch, once each, in one pass over the edges."""
    return edges.select(F.explode(F.array(src, dst)).alias("node")).distinct()


def agree(source: DataFrame, created: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, source, created): numbers of rows by key. A key whose numbers differ fails the job that reads it."""
    a = source.groupBy(*keys).agg(F.count("*").alias("source"))
    b = created.groupBy(*keys).agg(F.count("*").alias("created"))
    both = a.join(b, keys, "full").na.fill(0, ["source", "created"])
    told = F.concat(F.lit("created rows differ from the source: "), F.to_json(F.struct(*keys, "source", "created")))
    return both.withColumn("created", F.when(F.col("source") == F.col("created"), F.col("created")).otherwise(F.raise_error(told).cast("long")))

