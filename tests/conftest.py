import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def spark():
    from tallyhall.session import build_session
    s = build_session("local[*]", 8, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallyhall-tests-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


FACT_SCHEMA = ("event_id bigint, participant_id string, event_site_refid string, event_site_name string, "
               "event_site_state string, home_refid string, program string, program_name string, gender string, "
               "age string, oku_status string, attendance string, event_startdate date, event_start timestamp, "
               "category_name string, pillar_name string, sub_pillar_name string, requester_id bigint")


def make_fact(spark, rows):
    """Hand-built fact rows: dicts with any subset of FACT_SCHEMA columns."""
    cols = [c.split()[0] for c in FACT_SCHEMA.split(", ")]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, FACT_SCHEMA)


def make_sites(spark, rows):
    return spark.createDataFrame(rows, "refid string, site_name string, state string")
