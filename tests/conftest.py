from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from riskweave.session import get_spark  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("SPARK_DRIVER_MEMORY", "6g")
    session = get_spark("riskweave-tests", cores=8)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    """'03 12:30' or '03 12:30:00.000001' as a moment of January 2024."""
    day, clock = text.split(" ")
    clock = clock if clock.count(":") == 2 else f"{clock}:00"
    return datetime.fromisoformat(f"2024-01-{day}T{clock}")


def rows(df, *columns):
    """Rows as plain tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
