from .cleaning import clean_int_columns, drop_unknown  # noqa: F401
from .detail import build_detail, detail_from_driver, prefixed_calls  # noqa: F401
from .features import (  # noqa: F401
    classify_label, collect_parallel, collect_structs, collect_values, presence_flag,
    presence_flag_by_sum, presence_flags,
)
from .profile import (  # noqa: F401
    combination_coverage, distinct_per_group, key_cardinality, multi_valued_keys,
    ranked_values, value_combinations, values_per_key_histogram,
)
from .recency import recency_flags  # noqa: F401
from .sequence import global_position, rank_within, row_sequence  # noqa: F401
from .summary import base_by_max, best_row, build_summary  # noqa: F401
