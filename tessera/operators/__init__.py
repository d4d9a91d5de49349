"""DataFrame -> DataFrame building blocks of the report."""

from tessera.operators.fanout import joined_projections
from tessera.operators.flags import flag_pivot, presence_flag
from tessera.operators.lookup import (
    HotKeys, LookupCounts, duplicate_keys, hot_keys, left_join_spread, lookup, unique_rows,
)
from tessera.operators.scope import key_pool, scope_by_keys
from tessera.operators.textagg import joined_text, ordered_listagg
from tessera.operators.topn import first_per_key, latest_per_key
from tessera.operators.union import conform, hybrid_union, union_all

__all__ = [
    "HotKeys", "LookupCounts", "conform", "duplicate_keys", "first_per_key", "flag_pivot",
    "hot_keys", "hybrid_union", "joined_projections", "joined_text", "key_pool", "latest_per_key", "left_join_spread",
    "lookup", "ordered_listagg", "presence_flag", "scope_by_keys", "union_all", "unique_rows",
]
