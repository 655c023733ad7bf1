"""Pages reachable over links."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart.operators.joins import salts_of
from pagemart.session import delete_path, discard, materialise, scratch_path


class Adjacency:
    """Links written once, bucketed by source, and the nodes found, bucketed by node, one partition a depth.

    The links of a source that has very many are dealt over salts, which are part of the bucket key; ``salts``
    holds them; the edges are read once to count them and once to write them. A round then moves its frontier to the links and the reached nodes to the nodes found: neither the
    links nor what was found before is shuffled again.
    """

    def __init__(self, seeds: DataFrame, edges: DataFrame, buckets: int | None = None):
        self.spark = seeds.sparkSession
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        name = uuid.uuid4().hex
        self.links_name, self.found_name = f"links_{name}", f"found_{name}"
        self.links_path, self.found_path = scratch_path(self.spark, "links"), scratch_path(self.spark, "found")
        links = edges.select("src", "dst").where(F.col("src") != F.col("dst"))
        self.salts = materialise(salts_of(links.groupBy("src").count(), "src", self.buckets), "salts")
        spread = F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("dst"), "salts")).otherwise(0).cast("int")
        dealt = links.join(self.salts, "src", "left").select("src", spread.alias("salt"), "dst")
        dealt = dealt.repartition(self.buckets, "src", "salt").dropDuplicates(["src", "salt", "dst"])
        dealt.write.bucketBy(self.buckets, "src", "salt").option("path", self.links_path).saveAsTable(self.links_name)
        first = seeds.select("node").where("node is not null").distinct().withColumn("depth", F.lit(0)).repartition(self.buckets, "node")
        writer = first.write.partitionBy("depth").bucketBy(self.buckets, "node")
        writer.option("path", self.found_path).saveAsTable(self.found_name)

    def newest(self, depth: int) -> DataFrame:
        return self.spark.table(self.found_name).where(F.col("depth") == depth).select("node")

    def reached(self, depth: int) -> DataFrame:
        """The nodes first reached at this depth, from those of the depth before."""
        salt = F.explode(F.when(F.col("salts").isNotNull(), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array(F.lit(0))))
        front = self.newest(depth - 1).join(self.salts.withColumnRenamed("src", "node"), "node", "left")
        front = front.select(F.col("node").alias("src"), salt.alias("salt"))
        nodes = self.spark.table(self.links_name).join(front, ["src", "salt"], "left_semi")
        nodes = nodes.select(F.col("dst").alias("node")).where("node is not null").distinct()
        return nodes.join(self.spark.table(self.found_name).select("node"), "node", "left_anti")

    def store(self, depth: int) -> bool:
        """Append the next depth's nodes; whether there were any."""
        self.reached(depth).withColumn("depth", F.lit(depth)).write.insertInto(self.found_name)
        return not self.newest(depth).isEmpty()

    def close(self) -> None:
        """Forget both tables and delete the links; the files of the nodes stay for the result."""
        for name in (self.links_name, self.found_name):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(self.spark, self.links_path)
        discard(self.salts)


def reachable_pages(seeds: DataFrame, edges: DataFrame, max_rounds: int | None = None, buckets: int | None = None) -> DataFrame:
    """(node, depth) of every node reachable from the seeds, each once, at its least depth.

    ``seeds`` has a column ``node``, ``edges`` the columns ``src`` and ``dst``. Each round joins the newest nodes to
    the bucketed links, drops what was found before and appends the rest to the shared folder, so a plan spans
    one round and a lost executor costs one round at most. NULL nodes are left out.
    """
    kind = seeds.schema["node"].dataType.simpleString()
    graph = Adjacency(seeds, edges, buckets)
    try:
        depth = 1
        while (max_rounds is None or depth <= max_rounds) and graph.store(depth):
            depth += 1
    finally:
        graph.close()
    return graph.spark.read.schema(f"node {kind}, depth int").parquet(graph.found_path)
