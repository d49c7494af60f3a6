"""JDBC reader/writer option handling, checked without a database (none may
be started here): the Spark reader/writer calls are captured."""

from pyspark.sql import DataFrameReader, DataFrameWriter

from abode.sinks import write_jdbc
from abode.sources import read_jdbc
from tests.helpers import listing_frame, listing_row


def test_partitioned_read_arguments(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **kw: seen.update(url=url, table=table, **kw))
    read_jdbc(spark, "jdbc:x", "listings", {"user": "u"}, lower_bound=1, upper_bound=1000, num_partitions=4)
    assert seen["column"] == "listing_id" and seen["numPartitions"] == 4
    assert seen["lowerBound"] == 1 and seen["upperBound"] == 1000
    assert seen["properties"]["fetchsize"] == "10000" and seen["properties"]["user"] == "u"


def test_unbounded_read_is_single_slice(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **kw: seen.update(kw))
    read_jdbc(spark, "jdbc:x", "listings")
    assert "column" not in seen


def test_write_bounds_connections(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: seen.update(mode=mode, props=properties))
    write_jdbc(listing_frame(spark, [listing_row(1, "a")]), "jdbc:x", "listings", num_partitions=8)
    assert seen["mode"] == "append"
    assert seen["props"]["numPartitions"] == "8" and seen["props"]["batchsize"] == "10000"
