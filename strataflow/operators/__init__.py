from strataflow.operators.clean import CLEAN_RULES, CleanRule, clean, clean_report
from strataflow.operators.ordered import lagged, moving_average, ordinals, running_total
from strataflow.operators.pivot import pivot_filtered, share_of_total

__all__ = [
    "CLEAN_RULES", "CleanRule", "clean", "clean_report", "lagged", "moving_average", "ordinals", "pivot_filtered",
    "running_total", "share_of_total",
]
