"""Report lines. ``format_string`` pads without truncating, like Python's ``{x:<n}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import LABELLED_LINE, REPORT_LINE


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def fixed_width_line(id_="id", name="name", department="department", salary="salary", join_date="join_date") -> Column:
    return F.format_string(REPORT_LINE, _s(id_), _s(name), _s(department), _s(salary), _s(join_date))


def labelled_line(id_="id", name="name") -> Column:
    return F.format_string(LABELLED_LINE, _s(id_), _s(name))
