"""Diffusion graph job: relation files in; matrix, nodes and edges out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftline.operators import graph
from driftline.session import stage
from driftline.sinks.files import run_stamp, write_csv, write_graph
from driftline.sinks.tiles import write_tiles
from driftline.sources.tables import read_relations


def run(
    spark: SparkSession,
    relations: str,
    output: str,
    *,
    min_weight: int = 1,
    include_unresolved: bool = False,
    targets=(),
    tile_targets: int | None = None,
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Write ``relation_matrix`` and ``graph`` below ``output``; return the summaries.

    The matrix is written in its long form; wide for the ``targets`` named, and
    whole with ``tile_targets`` targets to a tile.
    """
    run_id = run_id or run_stamp()
    edges = stage(graph.forward_edges(read_relations(spark, relations), include_unresolved=include_unresolved))
    kept = graph.graph_edges(edges, min_weight=min_weight)
    write_csv(graph.relation_matrix_long(edges).orderBy("source", "target"), f"{output}/relation_matrix", run_id=run_id)
    if targets:
        write_csv(graph.relation_matrix(edges, targets), f"{output}/relation_matrix_wide", run_id=run_id)
    if tile_targets:
        write_tiles(edges, f"{output}/relation_matrix_tiles/run_id={run_id}", width=tile_targets)
    write_graph(graph.export_nodes(kept), graph.export_edges(graph.sorted_edges(kept)), f"{output}/graph", run_id=run_id)
    return {
        "matrix": graph.matrix_summary(edges),
        "graph": graph.graph_summary(kept),
        "top_edges": graph.top_edges(kept),
    }
