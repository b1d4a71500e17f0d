"""How the derived loan table is made."""

from loanclean import fixture


def test_orders_are_spread_not_the_wide_rows(spark, sf_dir, monkeypatch):
    plans = []
    monkeypatch.setattr(fixture, "_staged", {})
    monkeypatch.setattr(fixture, "SOURCE_BYTES", 10_000)
    monkeypatch.setattr(fixture, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    loans = fixture.raw_loans(spark, sf_dir)
    moves = [line for line in plans[0].splitlines() if "Exchange" in line]
    assert moves and all("hashpartitioning(o_orderkey" in line for line in moves)
    assert loans.count() == spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("count(*) + count_if(o_orderkey % 67 = 0)").first()[0]
    assert loans.rdd.getNumPartitions() > 1


def test_only_the_narrow_orders_are_written(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(fixture, "_staged", {})
    monkeypatch.setattr(fixture, "stage", lambda df, name: written.append((name, df.columns)) or df)
    orders = "select id as o_orderkey, id % 7 as o_custkey, id + 0.4D as o_totalprice, timestamp_ntz'2020-01-31 00:00:00' as o_orderdate, 'x' as o_comment from range(300)"
    spark.sql(orders).write.parquet(str(tmp_path / "orders.parquet"))
    made = {"loans": fixture.raw_loans, "clean": fixture.clean_loans, "layer2": fixture.layer2}
    for name, make in made.items():
        select = {"loans": fixture.loans_sql, "clean": fixture.clean_sql, "layer2": fixture.layer2_sql}[name]("{orders}")
        want = spark.sql(select, orders=spark.sql(orders))
        assert sorted(map(str, make(spark, str(tmp_path)).collect())) == sorted(map(str, want.collect()))
    assert written == [("fixture-orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])]
