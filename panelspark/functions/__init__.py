"""Column expressions.  Everything here returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from panelspark.functions.keys import composite_key, right_chars, starts_with, zfill
from panelspark.functions.numbers import (clip, complement, nan_to_null, null_infinite_col,
                                          null_sentinel_col, parse_grouped_number,
                                          rate, round_half_even, share, sum_cols,
                                          sum_cols_strict, to_number)
from panelspark.functions.rules import (case_ladder, feature_family, flag_in, flag_over,
                                        match_any_token)
from panelspark.functions.text import (clean_label, direction, fmt_num, fmt_pct,
                                       parse_param, parse_point, param_slug, slug)
from panelspark.functions.geo import haversine

__all__ = [
    "zfill", "composite_key", "right_chars", "starts_with",
    "to_number", "parse_grouped_number", "nan_to_null", "null_sentinel_col",
    "null_infinite_col", "share", "rate", "sum_cols", "sum_cols_strict", "clip",
    "complement", "round_half_even",
    "flag_over", "flag_in", "case_ladder", "feature_family", "match_any_token",
    "clean_label", "slug", "param_slug", "parse_param", "parse_point", "fmt_num",
    "fmt_pct", "direction", "haversine",
]
