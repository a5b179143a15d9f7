"""Generic DataFrame operators (see the README for the survey IDs they cover)."""

from homestat.operators.aggregates import arg_extreme, fixed_point_mean, group_mean, group_median, group_share
from homestat.operators.relational import (account_key, align_series, attach_scalar, bulk_keys, date_columns,
                                           drop_bulk, join_on_account, period_of, prior, select_existing,
                                           trailing, unpivot_dates, with_default)
from homestat.operators.splits import split_groups
from homestat.operators.windows import consecutive_pairs, direction, latest_n, pct_change, rank_by

__all__ = ["account_key", "align_series", "arg_extreme", "attach_scalar", "bulk_keys", "consecutive_pairs",
           "date_columns", "direction", "drop_bulk", "fixed_point_mean", "group_mean", "group_median",
           "group_share", "join_on_account", "latest_n", "pct_change", "period_of", "prior",
           "rank_by", "select_existing", "split_groups", "trailing", "unpivot_dates", "with_default"]
