"""Property tests."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.apportion import apportion
from strata.operators.dedup import first_per_key

WIDE = "order_id long, order_detail_id long, sku_price double, sku_num long, final_total_amount double, " \
       "original_total_amount double"

cents = st.integers(min_value=1, max_value=2_000_000)
order = st.tuples(st.lists(st.tuples(cents, st.integers(1, 50)), min_size=1, max_size=6), cents)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(orders=st.lists(order, min_size=1, max_size=30))
def test_cent_shares_add_up_to_final(spark, orders):
    rows = []
    for oid, (lines, final_c) in enumerate(orders):
        total = sum(Decimal(p) / 100 * q for p, q in lines)
        for lid, (p, q) in enumerate(lines):
            rows.append((oid, oid * 10 + lid, p / 100, q, final_c / 100, float(total)))
    out = apportion(spark.createDataFrame(rows, WIDE), scale=2, as_double=False)
    sums = {r.order_id: r.s for r in out.groupBy("order_id").agg(F.sum("final_detail_amount").alias("s")).collect()}
    for oid, (_lines, final_c) in enumerate(orders):
        assert sums[oid] == Decimal(final_c) / 100


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 10_000)), min_size=1, max_size=60),
       repeats=st.integers(1, 3))
def test_first_per_key_idempotent_under_redelivery(spark, logs, repeats):
    df = spark.createDataFrame([(f"m{m}", d, ts, i) for i, (m, d, ts) in enumerate(logs)],
                               "mid string, day long, ts long, offset long")
    once = sorted(tuple(r) for r in first_per_key(df, ["mid", "day"], ["ts", "offset"]).collect())
    again = df
    for _ in range(repeats):
        again = again.unionByName(df)
    twice = sorted(tuple(r) for r in first_per_key(again, ["mid", "day"], ["ts", "offset"]).collect())
    assert once == twice
