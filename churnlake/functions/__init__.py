from churnlake.functions.columns import floor_days, ts_lit, age_group_code, round_half_even
from churnlake.functions.prefix import prefix_sums, exact_quantiles, scalar_quantile

__all__ = ["floor_days", "ts_lit", "age_group_code", "round_half_even",
           "prefix_sums", "exact_quantiles", "scalar_quantile"]
