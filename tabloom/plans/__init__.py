"""Distributed building blocks that several operators share."""

from tabloom.plans.laplacian import laplacian_vectors
from tabloom.plans.links import KeyedLinks
from tabloom.plans.matmul import block_product
from tabloom.plans.neighbours import nearest_neighbours
from tabloom.plans.ordering import (
    exact_percentiles,
    largest_group,
    percentile_within,
    row_number_within,
    with_position,
)
from tabloom.plans.pairs import pair_sums, top_products
from tabloom.plans.runs import numbered
from tabloom.plans.storage import checkpointed, dropped, release, scratch, scratch_path, shared_dir, spread, written

__all__ = [
    "KeyedLinks",
    "block_product",
    "checkpointed",
    "dropped",
    "exact_percentiles",
    "laplacian_vectors",
    "largest_group",
    "nearest_neighbours",
    "numbered",
    "pair_sums",
    "percentile_within",
    "release",
    "row_number_within",
    "scratch",
    "scratch_path",
    "shared_dir",
    "spread",
    "top_products",
    "with_position",
    "written",
]
