"""Reusable DataFrame operators."""

from procura.operators.drill import drill, preview
from procura.operators.events import child_sum, first_event, last_action_rows, last_event, max_by_key
from procura.operators.joins import (
    anti_exists,
    dated_join,
    dated_lookup,
    full_outer,
    keyed_join,
    keyed_join_named,
    left_join_splittable,
    lineage_chain,
    lineage_parts,
    scalar_lookup,
    semi_in,
)
from procura.operators.sets import conform, union_distinct, union_distinct_stored
from procura.operators.strings import ordered_listagg, ordered_listagg_expr
from procura.operators.windows import latest_per_key

__all__ = [
    "anti_exists", "child_sum", "conform", "dated_join", "dated_lookup", "drill", "first_event",
    "full_outer", "keyed_join", "keyed_join_named", "left_join_splittable", "last_action_rows", "last_event", "latest_per_key", "lineage_chain", "lineage_parts",
    "max_by_key", "ordered_listagg", "ordered_listagg_expr", "preview", "scalar_lookup", "semi_in",
    "union_distinct", "union_distinct_stored",
]
