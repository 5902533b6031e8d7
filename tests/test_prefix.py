import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from driftline.operators.prefix import keyed_positions, keyed_running_sum


def test_positions_and_running_sums_with_a_hot_key(spark):
    rng = np.random.default_rng(4)
    n = 6000
    # key "hot" holds half of the rows; ranges must split it
    keys = np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b", "c", "d"], n))
    pdf = pd.DataFrame({"k": keys, "o": rng.permutation(n).astype("int64"),
                        "w": rng.integers(0, 5, n).astype("int64"), "x": rng.normal(size=n)})
    df = spark.createDataFrame(pdf)
    got = keyed_positions(df, ["k"], [F.col("o")], first_cols=["x"], num_ranges=7).toPandas()
    exp = pdf.sort_values(["k", "o"]).copy()
    exp["t"] = exp.groupby("k").cumcount()
    exp["x_first"] = exp.groupby("k")["x"].transform("first")
    m = got.merge(exp, on=["k", "o"], suffixes=("", "_e"))
    assert len(m) == n
    assert (m["t"] == m["t_e"]).all() and (m["x_first"] == m["x_first_e"]).all()
    rs = keyed_running_sum(df, ["k"], [F.col("o")], ["w"], num_ranges=7).toPandas()
    exp["cum_w"] = exp.groupby("k")["w"].cumsum()
    m = rs.merge(exp, on=["k", "o"], suffixes=("", "_e"))
    assert (m["cum_w"] == m["cum_w_e"]).all()
