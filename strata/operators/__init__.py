from strata.operators.calendar import date_dimension, date_dimension_covering, day_spine
from strata.operators.dims import assign_keys, dense_numbering, merge_type1
from strata.operators.facts import dedupe_grain, new_facts, prune_history, split_null_grain
from strata.operators.filters import fresh_since, having_value
from strata.operators.hierarchy import HierarchyDepthError, hierarchy_tier, hierarchy_tier_doubling
from strata.operators.nested import (explode_chain, explode_entries, explode_objects, explode_scalars,
                                     flatten_struct, typed)
from strata.operators.quality import (RunAudit, cast_rejects, enforce, key_violations, length_violations,
                                      merge_profiles, null_violations, profile, profile_day)
from strata.operators.rollups import child_counts, flat_lists, list_per_key
from strata.operators.windows import count_within, keep_lowest, keep_one, number_within

__all__ = [
    "date_dimension", "date_dimension_covering", "day_spine", "assign_keys", "dense_numbering",
    "merge_type1", "dedupe_grain", "new_facts", "prune_history", "split_null_grain", "fresh_since",
    "having_value", "HierarchyDepthError", "hierarchy_tier", "hierarchy_tier_doubling", "explode_chain", "explode_entries",
    "explode_objects", "explode_scalars", "flatten_struct", "typed", "RunAudit", "cast_rejects",
    "enforce", "key_violations", "length_violations", "null_violations", "profile", "profile_day", "merge_profiles", "child_counts",
    "flat_lists", "list_per_key", "count_within", "keep_lowest", "keep_one", "number_within",
]
