"""The player graph as tables that every micro-batch brings up to date, and the graph store it is exported to.

``GraphTables`` keeps one vertex per id, the edges, and edge counts per (id, side, champions): the degrees of any subgraph that is
cut by side and champions are sums over those counts, so the graph job reads counts instead of all edges of
all time, whatever the top champions are on the day.

``ExportStore`` is the target of the graph export: nodes and relationships are merged into what is there, and both become visible
in one commit, so a reader meets the old store or the new one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph
from ..operators.bans import top_banned
from .versions import BUCKETS, Appended, BucketStore, Keyed

VERTICES = Keyed("id BIGINT, name STRING, tracking BOOLEAN", ("id",), {"name": F.min, "tracking": F.bool_or})
COUNTS = Keyed("id BIGINT, side STRING, src_champ STRING, dst_champ STRING, in_degree BIGINT, out_degree BIGINT",
               ("id", "side", "src_champ", "dst_champ"), {"in_degree": F.sum, "out_degree": F.sum})
EDGES = Appended("src_id BIGINT, dst_id BIGINT, src_champ STRING, dst_champ STRING, side STRING")
NODES = Keyed("id BIGINT, name STRING", ("id",), {"name": F.min})
RELS = Keyed("src_id BIGINT, dst_id BIGINT, my_champion STRING", ("src_id", "dst_id", "my_champion"), {})


class GraphTables(BucketStore):
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, keep: int | None = None):
        """``keep``: versions kept after every batch (2 or more, as a replay starts from the one before its own); None keeps all."""
        super().__init__(spark, root, {"vertices": VERTICES, "counts": COUNTS, "edges": EDGES}, buckets)
        if keep is not None and keep < 2:
            raise ValueError("a replay needs the version before its own")
        self.keep = keep

    def add(self, match_edges: DataFrame, batch_id: int, id_mode: str = "key") -> None:
        """Bring vertices, counts and edges up to date with a batch of normalised edges."""
        edges = graph.oriented_edges(match_edges, id_mode)
        of = ("side", "src_champ", "dst_champ")
        ends = F.array(F.struct(F.col("src_id").alias("id"), F.lit(0).alias("in_degree"), F.lit(1).alias("out_degree")),
                       F.struct(F.col("dst_id").alias("id"), F.lit(1).alias("in_degree"), F.lit(0).alias("out_degree")))
        counts = edges.select(*of, F.explode(ends).alias("e")).select("e.*", *of)
        self.merge({"vertices": graph.vertex_rows(match_edges, id_mode), "counts": counts, "edges": edges}, batch_id)
        if self.keep:
            self.expire(self.keep)

    def graph(self) -> graph.PropertyGraph:
        """The whole graph; an id without a name is "Missing", one without a vertex row of its own not tracked."""
        v = self.read("vertices").select("id", F.coalesce("name", F.lit(graph.MISSING)).alias("name"),
                                         F.coalesce("tracking", F.lit(False)).alias("tracking"))
        return graph.PropertyGraph(vertices=v, edges=self.read("edges"))

    def banned_degrees(self, top: DataFrame) -> DataFrame:
        """(id, in_degree, out_degree) in the subgraph of "Against" edges that touch one of the ``top`` champions."""
        hit = graph.banned_edge(graph.champion_set(top))
        return self.read("counts").filter(hit).groupBy("id").agg(F.sum("in_degree").alias("in_degree"), F.sum("out_degree").alias("out_degree"))

    def job(self, ban_count: DataFrame, k: int = 3) -> DataFrame:
        """Tracked players with a degree in the banned subgraph: the graph job without a scan of the edges."""
        return (self.graph().vertices.filter("tracking").join(self.banned_degrees(top_banned(ban_count, k)), "id")
                .filter(F.col("in_degree") + F.col("out_degree") > 0).select("id", "name", "tracking", "in_degree", "out_degree"))


class ExportStore(BucketStore):
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        super().__init__(spark, root, {"nodes": NODES, "rels": RELS}, buckets)

    def load(self, g: graph.PropertyGraph) -> None:
        """Merge the USER nodes and BEAT relationships of a graph into the store (nodes on id, relationships on all fields)."""
        self.merge({"nodes": graph.export_nodes(g), "rels": graph.export_relationships(g)}, self.next_batch())
