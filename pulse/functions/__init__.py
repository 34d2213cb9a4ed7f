from pulse.functions.time import epoch_seconds, event_ts, iso_text, iso_to_epoch, with_time_partitions
from pulse.functions.values import default_false, flag_count, percent

__all__ = [
    "default_false",
    "epoch_seconds",
    "event_ts",
    "flag_count",
    "iso_text",
    "iso_to_epoch",
    "percent",
    "with_time_partitions",
]
