"""tallgrass: the reference's operators as Spark DataFrame plans.

Import the operator modules directly (``tallgrass.operators.text`` ...) or use
the names re-exported here.
"""

from tallgrass.functions.geo import Box, Grid
from tallgrass.functions.udfs import flat_map_batches
from tallgrass.operators.graph import (
    PropertyGraph,
    aggregate_messages,
    connected_components,
    edge_weights,
    in_degrees,
    join_vertices,
    map_edges,
    map_triplets,
    map_vertices,
    out_degrees,
    outer_join_vertices,
    subgraph,
    triangle_count,
    triplets,
    with_degrees,
)
from tallgrass.operators.keyed import cogroup, fold_by_key, group_values, lookup, reduce_by_key
from tallgrass.operators.pagerank import pagerank_pregel, pagerank_rounds, pagerank_tolerance, top_ranks
from tallgrass.operators.pregel import pregel
from tallgrass.operators.rides import clean, popular_places, terminal_counts, terminal_trends
from tallgrass.operators.skew import join_unique, ranked
from tallgrass.operators.text import top_long_words, top_words, word_count
from tallgrass.operators.topk import first_n, sample_n, top_k, top_k_distinct
from tallgrass.operators.weblog import client_sketches, merged_clients
from tallgrass.session import checkpoint_root, cut_lineage, get_session, release
from tallgrass.sources.records import parse_delimited, parse_json_lines, parse_row_xml, read_json_lines
from tallgrass.sources.weblog import parse_access_log, read_access_log, with_weekday
from tallgrass.streaming.bounded import event_time_slices, file_stream, run_bounded_stream
from tallgrass.streaming.upsert import LatestTable

__all__ = [
    "Box", "Grid", "LatestTable", "PropertyGraph", "aggregate_messages", "checkpoint_root", "clean",
    "client_sketches", "cogroup", "connected_components", "cut_lineage", "edge_weights", "event_time_slices",
    "file_stream", "first_n", "flat_map_batches", "fold_by_key", "get_session", "group_values", "in_degrees",
    "join_unique", "join_vertices", "lookup", "map_edges", "map_triplets", "map_vertices", "merged_clients",
    "out_degrees", "outer_join_vertices", "pagerank_pregel", "pagerank_rounds", "pagerank_tolerance",
    "parse_access_log", "parse_delimited", "parse_json_lines", "parse_row_xml", "popular_places", "pregel", "ranked",
    "read_access_log", "read_json_lines", "reduce_by_key", "release", "run_bounded_stream", "sample_n", "subgraph",
    "terminal_counts", "terminal_trends", "top_k", "top_k_distinct", "top_long_words", "top_ranks", "top_words",
    "triangle_count", "triplets", "with_degrees", "with_weekday", "word_count",
]
