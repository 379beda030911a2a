"""Date parsing and month labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the feeds: host_since is day/month/year text, scrape dates
# are ISO text. ``d/M/yyyy`` also accepts unpadded days and months.
HOST_SINCE_FORMAT = "d/M/yyyy"
SCRAPED_DATE_FORMAT = "yyyy-MM-dd"
MONTH_LABEL_FORMAT = "MM/yyyy"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, fmt: str) -> Column:
    """Text to date; empty or malformed text becomes NULL instead of failing."""
    return F.try_to_date(_col(c), fmt)


def month_label(c) -> Column:
    """``TO_CHAR(d, 'MM/YYYY')``. Note: sorts as text, not as time."""
    return F.date_format(_col(c), MONTH_LABEL_FORMAT)


def month_start(c) -> Column:
    """First day of the month: the time-ordered twin of ``month_label``."""
    return F.trunc(_col(c), "month")


def label_time_key(label) -> Column:
    """A text key over an ``MM/yyyy`` label that sorts in time order."""
    lab = _col(label)
    return F.concat(F.substring(lab, 4, 4), F.substring(lab, 1, 2))
