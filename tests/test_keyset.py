"""Pages by ranges of the key against the whole order."""

import pytest

from quillspan.plans.keyset import Keyset


def rows_of(spark, n):
    nan = float("nan")
    values = [None, 1.5, nan, -2.0, 0.0, 1.5]
    return spark.createDataFrame(
        [(i, values[i % 6], None if i % 5 == 0 else f"w{i % 3}") for i in range(n)], "id long, v double, w string"
    )


@pytest.mark.parametrize("sort", [[("v", "asc"), ("w", "desc")], [("w", "desc"), ("v", "desc")], [], [("id", "desc")]])
def test_pages_and_continuations_follow_the_order(spark, sort):
    df = rows_of(spark, 101).repartition(3)
    pages = Keyset(df, sort, "id", rows=10)
    assert pages.ranges.count() > 5
    whole = [r["id"] for r in df.orderBy(*pages.order).collect()]
    for size, numbers in ((7, (0, 5, 14, 15)), (40, (0, 1, 2))):
        for number in numbers:
            assert [r["id"] for r in pages.page(number, size).collect()] == whole[number * size : (number + 1) * size]
    read, last = [], pages.page(0, 30).collect()
    while last:
        read += [r["id"] for r in last]
        last = pages.after(last[-1], 30).collect()
    assert read == whole


def test_a_deep_page_reads_one_range(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    spark.range(10_000).selectExpr("id", "id * 2 AS v", "repeat('x', 5) AS pad").repartitionByRange(8, "v").write.parquet(path)
    stored = spark.read.parquet(path)
    deep = Keyset(stored, [("v", "asc")], "id", rows=1000).page(77, 100)
    assert [r["id"] for r in deep.collect()] == list(range(7700, 7800))
    pushed = next(line for line in deep._jdf.queryExecution().toString().splitlines() if "PushedFilters" in line)
    assert "LessThanOrEqual(v" in pushed and "GreaterThan" in pushed


def test_empty_collection(spark):
    pages = Keyset(rows_of(spark, 1).limit(0), [("v", "asc")], "id")
    assert pages.page(0, 10).count() == 0 and pages.page(3, 10).count() == 0


@pytest.mark.parametrize("rows", [10, 1000])
def test_ranges_name_their_first_and_last_key(spark, rows):
    pages = Keyset(rows_of(spark, 101), [], "id", rows=rows)
    ranges = [(r["first"]["k0"], r["last"]["k0"], r["n"]) for r in pages.ranges.orderBy("start").collect()]
    assert ranges[0][0] == 0 and ranges[-1][1] == 100 and all(last - first + 1 == n for first, last, n in ranges)
