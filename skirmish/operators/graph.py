"""Player-versus-player property graph on plain DataFrames.

A graph is a pair of DataFrames: vertices (id, name, tracking) and edges
(src_id, dst_id, src_champ, dst_champ, side).  GraphX has no Python API and a
graph library is not needed: every operator the graph job uses is a join or
an aggregation keyed by vertex id, which Spark partitions and combines
map-side, so hub players (huge degrees) only produce bigger partial counts,
never a giant adjacency list in one task.

Operators:
* oriented edges from normalised match edges (winner -> loser as stored),
* vertex extraction (tracked player + opponent) and completion of the vertex
  set with edge endpoints ("Missing", not tracked),
* graph statistics, the "Against + heavily banned champion" subgraph,
  in/out degrees joined onto vertices with default 0,
* the flagship question (tracked players adjacent to a top-banned champion),
* a one-hop pattern match and the node / relationship export tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import edge_attr_map, map_get
from ..functions.hashing import name_id
from ..session import materialize
from .joins import join_heavy

MISSING = "Missing"
NO_CHAMP = "No Champ"
AGAINST = "Against"


@dataclass(frozen=True)
class PropertyGraph:
    vertices: DataFrame  # id, name, tracking (one row per id)
    edges: DataFrame     # src_id, dst_id, src_champ, dst_champ, side


def _ids(edges: DataFrame, id_mode: str) -> tuple[F.Column, F.Column]:
    if id_mode == "key":
        return F.col("my_id"), F.col("his_id")
    return name_id("my_name", id_mode), name_id("his_name", id_mode)


def with_ids(match_edges: DataFrame, id_mode: str = "key") -> DataFrame:
    """Match edges whose ``my_id`` and ``his_id`` are those of ``id_mode``, so that everything after reads them in "key" mode."""
    me, him = _ids(match_edges, id_mode)
    return match_edges.withColumns({"my_id": me, "his_id": him})


def oriented_edges(match_edges: DataFrame, id_mode: str = "key",
                   orientation: str = "stored") -> DataFrame:
    """Edges of the graph from normalised match edges.

    ``stored`` keeps the reference orientation: when the other participant's
    outcome is not "Fail" the edge runs me -> him, else him -> me; champions
    and side are never swapped.  ``winner_to_loser`` flips the test so that an
    "Against" edge always points from the winner to the loser.
    """
    me, him = _ids(match_edges, id_mode)
    win = F.col("outcome") != "Fail"
    if orientation == "winner_to_loser":
        win = ~win
    elif orientation != "stored":
        raise ValueError(f"unknown orientation {orientation!r}")
    return match_edges.select(
        F.when(win, me).otherwise(him).alias("src_id"),
        F.when(win, him).otherwise(me).alias("dst_id"),
        F.col("my_champion").alias("src_champ"),
        F.col("his_champion").alias("dst_champ"),
        F.col("competition").alias("side"))


def extract_vertices(match_edges: DataFrame, id_mode: str = "key",
                     keep_empty_names: bool = False) -> DataFrame:
    """(id, name, tracking) rows of every edge, de-duplicated on all columns.

    Each edge yields (me, my name, true) and (him, his name, false) from a
    single scan.  Opponents without a name are dropped unless
    ``keep_empty_names`` (then all unknown players share one vertex when ids
    come from names).
    """
    me, him = _ids(match_edges, id_mode)
    pair = F.array(F.struct(me.alias("id"), F.col("my_name").alias("name"), F.lit(True).alias("tracking")),
                   F.struct(him.alias("id"), F.col("his_name").alias("name"), F.lit(False).alias("tracking")))
    v = match_edges.select(F.explode(pair).alias("v")).select("v.*")
    if not keep_empty_names:
        v = v.filter(~(~F.col("tracking") & (F.col("name") == "")))
    return v.distinct()


def _resolve_vertices(rows: DataFrame) -> DataFrame:
    """(id, name, tracking) rows -> one vertex per id.

    The smallest non-null name wins, tracked if any row is tracked; an id
    with no name is "Missing".  Rows are first collapsed per (id, name) with
    a hash aggregate (the name is a grouping key, so duplicates of a hub
    player collapse map-side); only that de-duplicated set reaches the
    per-id step, whose string minimum needs a sort-based aggregate.
    """
    pre = rows.groupBy("id", "name").agg(F.bool_or("tracking").alias("tracking"))
    return pre.groupBy("id").agg(F.coalesce(F.min("name"), F.lit(MISSING)).alias("name"),
                                 F.coalesce(F.bool_or("tracking"), F.lit(False)).alias("tracking"))


def build_graph(vertices: DataFrame, edges: DataFrame) -> PropertyGraph:
    """Graph with one vertex per id, including endpoints without a vertex row.

    Conflicting rows for an id are resolved deterministically: the smallest
    name, tracked if any row is tracked.  Ids seen only as edge endpoints get
    ("Missing", false).  One aggregation over the union, combined map-side.
    """
    ends = edges.select(F.explode(F.array("src_id", "dst_id")).alias("id"))
    rows = vertices.select("id", "name", "tracking").unionByName(
        ends.select("id", F.lit(None).cast("string").alias("name"),
                    F.lit(None).cast("boolean").alias("tracking")))
    return PropertyGraph(vertices=_resolve_vertices(rows), edges=edges)


def graph_from_match_edges(match_edges: DataFrame, id_mode: str = "key",
                           orientation: str = "stored") -> PropertyGraph:
    """The graph of normalised match edges, vertex set built in one pass.

    Every match edge contributes (me, my name, tracked) and (him, his name,
    not tracked); an opponent without a name contributes only his id, so he
    becomes "Missing" unless another row names him.  This equals
    ``build_graph(extract_vertices(e), oriented_edges(e))`` without a
    de-duplicating shuffle or a second scan of the edges for endpoints.
    """
    return PropertyGraph(vertices=_resolve_vertices(vertex_rows(match_edges, id_mode)),
                         edges=oriented_edges(match_edges, id_mode, orientation))


def vertex_rows(match_edges: DataFrame, id_mode: str = "key") -> DataFrame:
    """(id, name, tracking) of both ends of every edge; an opponent without a name has null name and tracking."""
    me, him = _ids(match_edges, id_mode)
    known = F.col("his_name") != ""
    rows = F.array(
        F.struct(me.alias("id"), F.col("my_name").alias("name"), F.lit(True).alias("tracking")),
        F.struct(him.alias("id"), F.when(known, F.col("his_name")).alias("name"),
                 F.when(known, F.lit(False)).alias("tracking")))
    return match_edges.select(F.explode(rows).alias("v")).select("v.*")


def graph_stats(g: PropertyGraph) -> DataFrame:
    """Vertex total, missing and tracked counts in one pass."""
    return g.vertices.agg(F.count(F.lit(1)).alias("n_vertices"),
                          F.count_if(F.col("name") == MISSING).alias("n_missing"),
                          F.count_if(F.col("tracking")).alias("n_tracked"))


def champion_set(top: DataFrame | F.Column) -> F.Column:
    """The champions of a k-row frame as one array value (scalar subquery).

    ``top`` is bounded by construction (a top-k), so collecting it into one
    value is safe; the subquery runs once and the result is inlined into the
    filters below, which then need no join at all.  Passing the returned
    column on (instead of the frame) shares one subquery between operators.
    """
    if isinstance(top, F.Column):
        return top
    return top.agg(F.collect_list("champion").alias("c")).scalar()


def banned_subgraph(g: PropertyGraph, top: DataFrame | F.Column) -> PropertyGraph:
    """Keep "Against" edges where either champion is one of ``top``.

    ``top`` is a k-row frame (column ``champion``) or its ``champion_set``.
    All vertices stay.
    """
    return PropertyGraph(vertices=g.vertices, edges=g.edges.filter(banned_edge(champion_set(top))))


def banned_edge(champs: F.Column) -> F.Column:
    """Test of an "Against" edge that touches one of the champions."""
    side = F.coalesce(F.col("side"), F.lit("None")) == AGAINST
    # One use of the subquery value for both endpoints (a second use would be
    # planned as a second subquery).
    hit = F.arrays_overlap(champs, F.array(F.coalesce(F.col("dst_champ"), F.lit("")),
                                           F.coalesce(F.col("src_champ"), F.lit(""))))
    return side & hit


def degrees(edges: DataFrame) -> DataFrame:
    """(id, in_degree, out_degree) for ids with at least one edge.

    Both directions come out of one aggregation (one shuffle, partial counts).
    """
    ends = F.array(F.struct(F.col("src_id").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
                   F.struct(F.col("dst_id").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")))
    e = edges.select(F.explode(ends).alias("e")).select("e.*")
    return e.groupBy("id").agg(F.sum("i").cast("bigint").alias("in_degree"),
                               F.sum("o").cast("bigint").alias("out_degree"))


def with_degrees(g: PropertyGraph) -> DataFrame:
    """Every vertex with its in/out degree in ``g`` (0 when it has none)."""
    d = degrees(g.edges)
    return (g.vertices.join(d, "id", "left")
            .select("id", "name", "tracking",
                    F.coalesce("in_degree", F.lit(0)).cast("bigint").alias("in_degree"),
                    F.coalesce("out_degree", F.lit(0)).cast("bigint").alias("out_degree")))


def tracked_with_edges(g: PropertyGraph) -> DataFrame:
    """Tracked vertices with in + out degree > 0 in ``g``.

    Written as an inner join on the degree table: a vertex without edges has
    no degree row, so this equals the outer join + filter of the graph job
    while letting both sides shrink before the join.
    """
    d = degrees(g.edges)
    return (g.vertices.filter(F.col("tracking")).join(d, "id")
            .filter(F.col("in_degree") + F.col("out_degree") > 0)
            .select("id", "name", "tracking", "in_degree", "out_degree"))


def pattern_hop(g: PropertyGraph, excluded: DataFrame | F.Column, heavy_share: float | None = None) -> DataFrame:
    """One hop ``(n)-[r]->(m)`` whose relationship champion is not excluded.

    Returns n's id and name with the target id and the relationship's
    champion (``src_champ``, "No Champ" when absent).  The excluded list is a
    k-row frame, applied as one inlined array value.  With ``heavy_share`` the
    relationships of hub players (that share of all or more) are joined without a shuffle.
    """
    rel = g.edges.select("src_id", "dst_id",
                         F.coalesce(F.col("src_champ"), F.lit(NO_CHAMP)).alias("my_champion"))
    rel = rel.filter(~F.array_contains(champion_set(excluded), F.col("my_champion")))
    v = g.vertices.select(F.col("id").alias("src_id"), "id", "name")
    met = rel.join(v, "src_id") if heavy_share is None else join_heavy(rel, v, "src_id", heavy_share)
    return met.select("id", "name", "dst_id", "my_champion")


def edge_attributes(edges: DataFrame) -> DataFrame:
    """Edges with their attribute map and the graph job's map lookups."""
    m = edge_attr_map()
    e = edges.select("src_id", "dst_id", m.alias("attr"))
    return e.select("src_id", "dst_id",
                    map_get("attr", "myChampion", NO_CHAMP).alias("my_champion"),
                    map_get("attr", "hisChampion", "").alias("his_champion"),
                    map_get("attr", "Side", "None").alias("side"))


def export_nodes(g: PropertyGraph) -> DataFrame:
    """USER nodes (id, name), merged on id."""
    return g.vertices.select("id", "name").dropDuplicates(["id"])


def export_relationships(g: PropertyGraph) -> DataFrame:
    """BEAT relationships (src_id, dst_id, my_champion), merged on all fields."""
    return g.edges.select("src_id", "dst_id",
                          F.coalesce(F.col("src_champ"), F.lit(NO_CHAMP)).alias("my_champion")).distinct()


def graph_job(spark, edges_path: str, vertices_path: str, ban_count: DataFrame, k: int = 3,
              fmt: str = "parquet", export_path: str | None = None) -> DataFrame:
    """The batch graph job over written edge / vertex files.

    Reads the files (any number of per-batch folders), completes the vertex
    set, keeps "Against" edges touching the k most banned champions and
    returns the tracked players with a degree in that subgraph.  With
    ``export_path`` the USER nodes and BEAT relationships are (over)written
    there as the graph-store load.
    """
    from ..operators.bans import top_banned
    from ..sources.graph_files import read_edges, read_vertices

    g = build_graph(read_vertices(spark, vertices_path, fmt), read_edges(spark, edges_path, fmt))
    sub = banned_subgraph(g, top_banned(ban_count, k))
    if export_path:  # nodes, relationships and the result share one evaluation of the graph
        sub = PropertyGraph(vertices=materialize(sub.vertices, "graph-vertices"), edges=materialize(sub.edges, "graph-edges"))
        export_nodes(sub).write.mode("overwrite").parquet(f"{export_path}/nodes")
        export_relationships(sub).write.mode("overwrite").parquet(f"{export_path}/rels")
    return tracked_with_edges(sub)
