"""Blocked evaluation must give the rows of the plain window."""

import random

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from formline.operators.ordered import Framed, Running, hot_groups, over_ordered

def _outputs():
    return [
        Running("n", F.lit(1), "count"),
        Running("total", F.col("v"), "sum"),
        Running("before", F.col("v"), "sum", strict=True),
        Running("top", F.col("v"), "max"),
        Running("known", F.col("v"), "last", strict=True),
        Framed("mean3", lambda w: F.avg("v").over(w.rowsBetween(-3, -1)), back=3),
        Framed("lag1", lambda w: F.lag("v").over(w), back=1),
        Framed("next2", lambda w: F.lead("v", 2).over(w), ahead=2),
        Framed("is_last", lambda w: F.lead(F.lit(1)).over(w).isNull(), ahead=1),
    ]


def _frame(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        key = None if i % 7 == 0 else ("hot" if i % 3 else f"k{i % 11}")
        value = None if rng.random() < 0.4 else rng.randint(0, 50)
        rows.append((key, rng.randint(0, 40), i, value))
    return spark.createDataFrame(rows, "k string, d int, id int, v int")


@pytest.mark.parametrize("order", ["up", "down"])
@pytest.mark.parametrize("keys", [["k"], []])
def test_blocks_equal_plain_window(spark, tiny_groups, keys, order):
    order = ("d", "id") if order == "up" else (F.col("d").desc(), F.col("id").asc())
    outputs = _outputs()
    df = _frame(spark)
    assert hot_groups(df, keys) is not None
    got = over_ordered(df, keys, order, outputs)
    window = Window.partitionBy(*keys).orderBy(*order)
    want = df.select("*", *[o.over(window).alias(o.alias) for o in outputs])
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want)


def test_small_tables_keep_the_plain_window(spark):
    df = _frame(spark)
    assert hot_groups(df, ["k"]) is None
    assert hot_groups(df, ["k"], bounded_by=[df]) is None
