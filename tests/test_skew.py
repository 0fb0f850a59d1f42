from pyspark.sql import Window
from pyspark.sql import functions as F

from threadtables.operators.skew import group_rank, join_texts


def _rows(spark):
    """One group holds half of all rows, and half of its rows share one order key."""
    hot = [("hot", i % 50 if i % 2 else 0, i) for i in range(3000)]
    cold = [(f"g{i % 300}", i % 7, i) for i in range(3000)]
    none = [(None, i % 5, i) for i in range(40)]
    return spark.createDataFrame(hot + cold + none, "g string, a int, b int")


def test_rank_of_hot_groups_is_the_plain_rank(spark):
    """Hot, cold and NULL groups on the same path, over many partitions."""
    df = _rows(spark)
    plain = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy("a", "b")))
    ranked = group_rank(df, ["g"], ["a", "b"], "rank")
    assert ranked.columns == plain.columns
    assert sorted(map(tuple, ranked.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_texts_of_hot_groups_are_joined_whole(spark):
    cells = dict(map(tuple, join_texts(_rows(spark).withColumn("t", F.col("b").cast("string")), ["g"], ["a", "b"], "t", "-", "cell").collect()))
    groups = {}
    for g, a, b in map(tuple, _rows(spark).collect()):
        groups.setdefault(g, []).append((a, b))
    assert cells == {g: "-".join(str(b) for _, b in sorted(rows)) for g, rows in groups.items()}
