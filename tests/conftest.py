import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402

BASE = dt.datetime(2000, 1, 1)
NOW = 100  # the run's as_of, in days after BASE
INF = "inf"


@pytest.fixture(scope="session")
def spark():
    # small frames: compiling code for each plan would take longer than running it
    s = local_session("4", shuffle_partitions=2, app="tidemark-tests", extra={"spark.sql.codegen.wholeStage": "false", "spark.sql.execution.rangeExchange.sampleSizePerPartition": "20"})
    yield s
    s.stop()


def day(n):
    """Instant ``n`` (days after 2000-01-01); ``inf`` -> the business open end."""
    if n == INF:
        return dt.datetime(9999, 12, 31)
    return BASE + dt.timedelta(days=n)


def as_of():
    return day(NOW).isoformat(sep=" ")


def undo(ts):
    """Timestamp -> instant number (or ``inf``) for readable assertions."""
    if ts.year >= 9999:
        return INF
    return (ts - BASE).days
