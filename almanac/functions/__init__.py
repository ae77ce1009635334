from almanac.functions.scalar import (log_cols, antilog_cols, date_stamp, month_start,
                                      month_index, ape)
from almanac.functions.metrics import MAPE, mape, mape_col, mape_frame

__all__ = ["log_cols", "antilog_cols", "date_stamp", "month_start", "month_index", "ape",
           "MAPE", "mape", "mape_col", "mape_frame"]
