from ledgerflow.functions.calendar import (  # noqa: F401
    CUTOVER_HOUR, batch_due, logical_day, logical_day_between, logical_day_py)
from ledgerflow.functions.scalars import (  # noqa: F401
    epoch_seconds_to_ts, epoch_seconds_to_ts_ntz, hour_of, iso_year_week, join_labels, ratio_pct,
    ratio_pct_parity, to_major_units, to_minor_units, year_week)
