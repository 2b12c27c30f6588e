"""DataFrame operators, independent of any one model."""

from revloom.operators.batches import fixed_size_batches, number_rows
from revloom.operators.flatten import Field, flatten
from revloom.operators.histogram import histogram
from revloom.operators.keep_first import ascending, keep_first, keep_last
from revloom.operators.links import (
    best_in_row,
    best_target,
    explode_links,
    labeled_pairs,
    one_per_pair,
    pairs_in_row,
)
from revloom.operators.lookup import hot_keys, lookup_join
from revloom.operators.rollup import attach_rollup
from revloom.operators.upsert import incremental_upsert, latest_per_key, unique_batch, upsert

__all__ = [
    "Field",
    "ascending",
    "attach_rollup",
    "best_in_row",
    "best_target",
    "explode_links",
    "fixed_size_batches",
    "flatten",
    "histogram",
    "hot_keys",
    "incremental_upsert",
    "keep_first",
    "keep_last",
    "labeled_pairs",
    "latest_per_key",
    "lookup_join",
    "number_rows",
    "one_per_pair",
    "pairs_in_row",
    "unique_batch",
    "upsert",
]
