from almanac.operators.filters import (TRAIN, VALIDATION, TEST, filter_rows, lag_complete,
                                       month_split, split_on_month, split_label, fill_missing,
                                       drop_vectors, before_month, after_month)
from almanac.operators.reshape import unpivot
from almanac.operators.joins import hot_keys, join, salted_join
from almanac.operators.aggregate import group_agg
from almanac.operators.window import fill_month_gaps, lag_features, lag_features_ranged, lag_names
from almanac.operators.encode import assemble, category_index, feature_array, nominal, nominal_sizes, vector_as_array

__all__ = ["TRAIN", "VALIDATION", "TEST", "filter_rows", "lag_complete", "month_split",
           "split_on_month", "split_label", "fill_missing", "drop_vectors", "before_month",
           "after_month", "unpivot", "join", "hot_keys", "salted_join", "group_agg", "lag_features",
           "lag_names", "fill_month_gaps", "category_index", "assemble", "feature_array", "vector_as_array",
           "nominal", "nominal_sizes", "lag_features_ranged"]
