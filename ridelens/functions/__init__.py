from ridelens.functions.casts import to_double, to_epoch_seconds, to_float, to_int_truncating
from ridelens.functions.dates import as_date, day_of, epoch_to_date, month_of, year_of
from ridelens.functions.keys import borough_route, business_month, log10_positive, zone_route

__all__ = [
    "to_double", "to_epoch_seconds", "to_float", "to_int_truncating",
    "as_date", "day_of", "epoch_to_date", "month_of", "year_of",
    "borough_route", "business_month", "log10_positive", "zone_route",
]
