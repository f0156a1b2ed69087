import os
import sys
from datetime import datetime

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickweave.session import get_session
    s = get_session("local[4]", 4, app_name="clickweave-tests")
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_stays_persisted():
    """What a module's tests persist is released behind them."""
    yield
    from pyspark.sql import SparkSession
    if (s := SparkSession.getActiveSession()) is not None:
        s.catalog.clearCache()


def ev(user="u1", product="p1", action="view", ts="2024-01-05 10:00:00", session="s1",
       category="Books", price=10.0, agent=None, ip="10.0.0.1", referrer=None, event_id=None):
    t = datetime.fromisoformat(ts) if isinstance(ts, str) else ts
    return (user, product, action, t, session, category, price, agent, ip, referrer, event_id)


EVENT_DDL = ("user_id string, product_id string, action_type string, timestamp timestamp, "
             "session_id string, product_category string, product_price double, user_agent string, "
             "ip_address string, referrer string, event_id long")


@pytest.fixture
def make_events(spark):
    def build(rows):
        return spark.createDataFrame(rows, EVENT_DDL)
    return build
