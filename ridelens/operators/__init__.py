from ridelens.operators.aggregate import count_between, count_by, count_by_category, mean_by_sum_count
from ridelens.operators.exact import aggregate_exactly
from ridelens.operators.zone_merge import ZoneLookup, enrich, prepare_lookup, unique_lookup
from ridelens.operators.filters import between_places, equals, in_month
from ridelens.operators.rank import rank_within, top_k_per_group, top_n

__all__ = [
    "count_between", "count_by", "count_by_category", "mean_by_sum_count",
    "aggregate_exactly",
    "ZoneLookup", "enrich", "prepare_lookup", "unique_lookup",
    "between_places", "equals", "in_month",
    "rank_within", "top_k_per_group", "top_n",
]
