"""Search by index against the plain search, and what it reads."""

import pytest
from pyspark.sql import functions as F

from abode import catalog
from abode.operators import reports, search_index
from abode.plans import joins
from tests.conftest import SF_SMALL
from tests.helpers import listing_frame, listing_row

ODD = ["ÉCOLE 1, Île", "école 2, ÎLE", "a%b_c 'q' \\x, Y", "", "ab", "abc", "aaa", "aaaaaa", "日本橋1, 東京", "İstanbul, X", "tab\tb, X", None]
TERMS = ["nation_1", "NATION_1", "furniture, nation_2", "1 FURNITURE, NATION_24", "12", "", "a", "ab", "abc", "aaa", "aaaa", "zzz", "É", "école", "ÎLE",
         "%b_", "'q'", "\\x", "日本橋", "橋1, 東", "b_c '", "i̇s", "nat ion", "tab\tb", ", "]


@pytest.fixture(scope="module")
def indexed(spark):
    from abode.session import scratch_path

    table = catalog.listings(spark, SF_SMALL)
    odd = listing_frame(spark, [listing_row(1_000_000 + i, a) for i, a in enumerate(ODD)])
    table = table.unionByName(odd).checkpoint()
    path = scratch_path(spark, "index")
    search_index.write_search_index(table, path, buckets=16, parts=32)
    return table, path


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("term", TERMS)
def test_same_rows_as_the_plain_search(spark, indexed, term):
    table, path = indexed
    assert rows(search_index.search_by_index(spark, path, term)) == rows(reports.address_search(table, term))


def test_beyond_the_broadcast_bound(spark, indexed, monkeypatch):
    table, path = indexed
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 0)
    assert rows(search_index.search_by_index(spark, path, "nation_1")) == rows(reports.address_search(table, "nation_1"))


def test_a_rare_term_reads_few_folders(spark, indexed):
    table, path = indexed
    found = search_index.search_by_index(spark, path, "1 FURNITURE, NATION_24")
    assert 1 <= found.count() < 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [id_part" in plan
    lists = search_index.candidates(spark, path, "furn")
    lists.collect()
    scan = next(x for x in lists._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PartitionFilters: [gram_bucket" in scan and "In(gram, [fur,urn])" in scan
    with pytest.raises(FileExistsError):
        search_index.write_search_index(table, path)


def test_trigrams(spark):
    df = spark.createDataFrame([("AbCabc",), ("ab",), ("",), (None,)], "t string").select(search_index.trigrams(F.col("t")).alias("g"))
    assert [r["g"] for r in df.collect()] == [["abc", "bca", "cab"], [], [], []]
