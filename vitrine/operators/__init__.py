"""Distributed operators shared by the analyses."""

from vitrine.operators.groups import leave_one_out_in_list, leave_one_out_mean, nest
from vitrine.operators.joins import (
    above_scalar,
    inequality_join,
    pairs_below,
    place_by_value,
    join_on_keys,
    lookup,
    nearest_k,
    one_row,
)
from vitrine.operators.materialize import reuse
from vitrine.operators.order_stats import band_expr, bands, cut_values, exact_order_stats, order_stats
from vitrine.operators.ranking import (
    argmax_expr,
    argmax_per_group,
    mode_per_group,
    order_columns,
    rank_per_group,
    top_k_per_group,
)

__all__ = [
    "above_scalar",
    "argmax_expr",
    "argmax_per_group",
    "band_expr",
    "bands",
    "cut_values",
    "exact_order_stats",
    "order_stats",
    "inequality_join",
    "pairs_below",
    "place_by_value",
    "join_on_keys",
    "lookup",
    "leave_one_out_in_list",
    "leave_one_out_mean",
    "mode_per_group",
    "nearest_k",
    "nest",
    "one_row",
    "order_columns",
    "rank_per_group",
    "reuse",
    "top_k_per_group",
]
