"""Column-expression helpers: money arithmetic, rounding and time."""

from mercato.functions.money import (  # noqa: F401
    MONEY, PCT,
    minor_units, exact_sum, sum_gross, sum_net, sum_discount, sum_cost,
    round_to, ratio, avg_of, decimals_to_double,
)
from mercato.functions.timefn import (  # noqa: F401
    as_of_col, ts_ntz, hour_floor, calendar_days, epoch_seconds, seconds_between,
)
