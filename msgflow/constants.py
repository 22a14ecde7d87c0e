"""Tags, codes, formats and defaults that results must reproduce exactly."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

# Fixed values ---------------------------------------------------------------
DROP = "U+005C__DROP__"
INTERNAL_ERROR_CODE = "Internal error"
DEFAULT_CONTAINER = "unknown-container"
MISSING_EVENT_TIME = "0001-01-01 00:00:00"
MAX_TIME = "9999-12-31 23:59:59.999999"
EPOCH = "1970-01-01 00:00:00"
DEFAULT_SLOT = "slot-0"
NO_SIDE_INPUT = "no_value"
STATUSES = ("SUCCESS", "FAILURE", "FALLBACK", "SERVE", "ON_SUCCESS")
PAYLOAD_FORMAT = "payload:%s event_time:%s watermark:%s"
COUNTER_FORMAT = "counter:%d interval_window_start:%s interval_window_end:%s"
FINAL_COUNTER_FORMAT = "counter:%d (FINAL) interval_window_start:%s interval_window_end:%s"
# ----------------------------------------------------------------------------

MISSING_TIME = datetime(1, 1, 1, tzinfo=timezone.utc)
EPOCH_TIME = datetime(1970, 1, 1, tzinfo=timezone.utc)


def at_micros(micros: int) -> datetime:
    return EPOCH_TIME + timedelta(microseconds=micros)
