"""Name search by index against the scan, and what it reads."""

import pytest

from reviewloom.operators.filters import search_names
from reviewloom.operators.names import build_name_index, search_index, trigrams

NAMES = ["Red Robin", "red rooster grill", "Ünder the Öak", "ab", "", "a", None, "100% Pure_Juice", "Joe's", "漢字食堂", "aaaaaa", "Red Robin", "C:\\Diner"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows = [(n, f"b{i:03d}", "x", "y", 3.5, i, ["c"]) for i, n in enumerate(NAMES + [f"Filler number {i}" for i in range(300)])]
    schema = "name string, business_id string, city string, state string, stars double, review_count long, categories array<string>"
    business = spark.createDataFrame(rows, schema)
    return business, build_name_index(business, str(tmp_path_factory.mktemp("names") / "index"), 16)


def ids(df):
    return sorted(r.business_id for r in df.collect())


@pytest.mark.parametrize("text", ["red r", "RED ROBIN", "öak", "ab", "a", "", None, "aaaa", "joe's", "食堂", "字食堂", "number 29", "not there", "% p", "100%", "c:\\d", "e_j"])
@pytest.mark.parametrize("wildcards", [False, True])
def test_same_rows_as_the_scan(tables, text, wildcards):
    business, index = tables
    if wildcards and text == "c:\\d":
        text = "c:\\\\d"  # an escaped sign
    got = search_index(index, text, wildcards)
    assert got.columns == search_names(business, text, wildcards).columns
    assert ids(got) == ids(search_names(business, text, wildcards))


def test_wildcards_between_letters(tables):
    business, index = tables
    for text in ("r_d%gri", "fil%ber 1_", "%%", "_", "ünd%öak", "red%zzz"):
        assert ids(search_index(index, text, True)) == ids(search_names(business, text, True))


def test_reads_only_the_folders_it_needs(tables):
    business, index = tables
    plan = search_index(index, "rooster")._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert len(filters) == 2 and all("bucket" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in filters)
    read = search_index(index, "rooster").select("business_id").inputFiles()
    assert 0 < len(read)
    rows = index.of_bucket("postings", [3]).selectExpr("_metadata.file_path AS p").distinct().collect()
    assert rows and all("bucket=3/" in r.p for r in rows)


def test_trigrams():
    assert trigrams("aaaa") == ["aaa"] and trigrams("ab") == [] and trigrams("abcab") == ["abc", "bca", "cab"]


def test_empty_table(spark, tables, tmp_path):
    index = build_name_index(tables[0].limit(0), str(tmp_path / "none"), 4)
    assert ids(search_index(index, "red")) == ids(search_index(index, "r")) == []
