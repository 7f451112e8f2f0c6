"""Every query with SQL against DuckDB on the smallest tables; the others must run."""

import duckdb
import pytest

import lodestone.page_queries  # noqa: F401  registers its queries
import lodestone.report_queries  # noqa: F401  registers its queries
import lodestone.service_queries  # noqa: F401  registers its queries
from lodestone.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def norm(v):
    return repr(round(v, 9) + 0.0) if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    rows = df.collect()
    if name in ORACLES:
        r = duck.execute(ORACLES[name])
        columns = [x[0] for x in r.description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(tuple(norm(x[c]) for c in columns) for x in rows) == sorted(tuple(map(norm, x)) for x in r.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_prose_of_one_row_group_is_read_by_many_tasks(spark, tmp_path):
    """A row group is one task's, and the matcher's work is that of its rows."""
    from pyspark.sql import functions as F

    import __spark_entry__

    rows = spark.range(0, 400, 1, 1).selectExpr("id l_orderkey", "cast(id % 7 as int) l_linenumber", "id % 10 l_suppkey")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = __spark_entry__.queries()["entity_references"](spark, str(tmp_path))
    assert got.count() == 400 * 6
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
