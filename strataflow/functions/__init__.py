from strataflow.functions.business import channel, freight, line_amount, line_discount, net_price, safe_ratio, status_band
from strataflow.functions.timing import (
    clock_hms,
    duration_minutes,
    epoch_micros,
    hours_between,
    time_bucket,
    to_business_time,
    wall,
)

__all__ = [
    "channel", "clock_hms", "duration_minutes", "epoch_micros", "freight", "hours_between", "line_amount",
    "line_discount", "net_price", "safe_ratio", "status_band", "time_bucket", "to_business_time", "wall",
]
