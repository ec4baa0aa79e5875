from __future__ import annotations

import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from footfall.schemas import DETAIL, RAW  # noqa: E402
from footfall.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("catalog")
    spark = session(
        "tests",
        "local[4]",
        4,
        settings={
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.driver.memory": "3g",
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


def epoch(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


@pytest.fixture
def raw_of(spark):
    """Raw rows from (user, item, category, behavior, epoch or text time) tuples."""

    def make(*rows):
        fixed = [(*r[:4], epoch(r[4]) if isinstance(r[4], str) else r[4]) for r in rows]
        return spark.createDataFrame(fixed, RAW)

    return make


@pytest.fixture
def detail_of(spark):
    """Detail rows from (user, item, category, behavior, 'yyyy-MM-dd HH:mm:ss') tuples."""

    def make(*rows):
        full = []
        for user, item, category, behavior, at in rows:
            t = datetime.fromisoformat(at)
            dow = t.isoweekday() % 7 + 1
            full.append(
                (user, item, category, behavior, at, t.hour, dow, int(dow in (1, 7)), at[:10])
            )
        return spark.createDataFrame(full, DETAIL)

    return make


def rows(df):
    return [tuple(r) for r in df.collect()]
