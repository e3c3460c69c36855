import math
import random
import statistics
from collections import Counter

import pytest

from tidegauge.operators.median import weighted_median

SCHEMA = "g STRING, v DOUBLE, n LONG, s DOUBLE"


def counted(spark, groups):
    rows = [
        (g, v, n, n / 2)
        for g, values in groups.items()
        for v, n in Counter(values).items()
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).persist()


def medians(counts, **limits):
    rows = weighted_median(counts, ["g"], "v", "n", sums=["s"], keep=lambda df: df.persist(), **limits).collect()
    assert len(rows) == len({r["g"] for r in rows})
    return {r["g"]: (r["n"], r["s"], r["median"]) for r in rows}


def expected(groups):
    return {g: (len(v), len(v) / 2, statistics.median(v)) for g, v in groups.items()}


def random_groups(seed):
    draw = random.Random(seed)
    groups = {
        "hot": [round(draw.gauss(50, 20), 2) for _ in range(3000)],
        "copies": [41.5] * 2000 + [draw.random() for _ in range(draw.randrange(300))],
        "two": [1.0, 2.0],
        "one": [7.25],
        "negative": [-draw.random() for _ in range(501)],
        "spread": [draw.choice([-1, 1]) * math.exp(draw.uniform(-300, 300)) for _ in range(400)],
    }
    for i in range(20):
        groups[f"g{i}"] = [draw.randrange(12) / 4 for _ in range(draw.randrange(1, 40))]
    return groups


# Limits from "sort every group in one task" to "split every group over many ranges".
@pytest.mark.parametrize("large_group, range_rows", [(10**6, 10**6), (300, 10**6), (300, 70), (1, 40), (0, 7)])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, large_group, range_rows):
    groups = random_groups(seed)
    assert medians(counted(spark, groups), large_group=large_group, range_rows=range_rows) == expected(groups)


@pytest.mark.parametrize("large_group", [10**6, 0])
def test_infinities_and_nan_sort_last(spark, large_group):
    groups = {
        "inf": [1.0, math.inf, math.inf],
        "low": [-math.inf, 2.0, 3.0],
        "both": [-math.inf, math.inf],
        "nan": [1.0, 2.0, math.nan],
        "half": [1.0, math.nan],
    }
    rows = medians(counted(spark, groups), large_group=large_group, range_rows=2)
    assert rows["inf"][2] == math.inf
    assert rows["low"][2] == 2.0
    assert math.isnan(rows["both"][2])
    assert rows["nan"][2] == 2.0
    assert math.isnan(rows["half"][2])


def test_frequencies_beyond_32_bits(spark):
    big = 2**40
    counts = spark.createDataFrame([("g", 1.0, big, 0.0), ("g", 2.0, big, 0.0), ("g", 3.0, 1, 0.0)], SCHEMA).persist()
    assert medians(counts)["g"] == (2 * big + 1, 0.0, 2.0)
    assert medians(counts, large_group=0, range_rows=1)["g"] == (2 * big + 1, 0.0, 2.0)


def test_no_rows(spark):
    assert medians(spark.createDataFrame([], SCHEMA)) == {}


def test_written_tables_are_the_default(spark):
    groups = random_groups(3)
    rows = weighted_median(counted(spark, groups), ["g"], "v", "n", large_group=100, range_rows=50).collect()
    assert {r["g"]: r["median"] for r in rows} == {g: statistics.median(v) for g, v in groups.items()}


@pytest.mark.parametrize("large_group", [10**6, 0])
def test_the_middle_of_an_odd_group_is_the_reading_itself(spark, large_group):
    groups = {"one": [1.7e308], "three": [-1.7e308, 1.7e308, 1.7e308]}
    assert {g: r[2] for g, r in medians(counted(spark, groups), large_group=large_group, range_rows=1).items()} == {
        "one": 1.7e308, "three": 1.7e308}
