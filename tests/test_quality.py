"""Validation checks: outcomes and which checks are (not) emitted."""

from barline.operators import quality as Q


def _checks(df, rules, name="t"):
    return {r["check_name"]: r for r in Q.validate_dataset(df, rules, name).collect()}


def test_null_ratio_pass_and_fail(spark):
    df = spark.createDataFrame([(float(i) if i % 5 else None,) for i in range(10)], "last double")
    rules = Q.DatasetRules((), ("last",), 0.3, ())
    c = _checks(df, rules)
    assert c["Null ratio for 'last'"]["passed"] is True
    assert c["Null ratio for 'last'"]["observed"] == 0.2
    df2 = spark.createDataFrame([(None,)] * 8 + [(1.0,)] * 2, "last double")
    assert _checks(df2, Q.DatasetRules((), ("last",), 0.1, ()))["Null ratio for 'last'"]["passed"] is False


def test_absent_column_emits_no_check(spark):
    df = spark.createDataFrame([(1.0,)], "other double")
    names = set(_checks(df, Q.DatasetRules((), ("last",), 0.1, ())))
    assert names == {"DataFrame not empty", "Required columns present"}


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B")], "timestamp int, name string")
    c = _checks(df, Q.DatasetRules((), (), 0.1, ("timestamp", "name")))
    d = c["No duplicates on ['timestamp', 'name']"]
    assert d["passed"] is False and d["observed"] == 1.0
    none = _checks(df.select("name").withColumnRenamed("name", "x"), Q.DatasetRules((), (), 0.1, ("timestamp",)))
    assert not any(k.startswith("No duplicates") for k in none)


def test_null_keys_are_equal(spark):
    df = spark.createDataFrame([(None, "A"), (None, "A")], "timestamp int, name string")
    assert Q.duplicate_count(df, ["timestamp", "name"]).collect()[0]["n_dupes"] == 1


def test_sign_check(spark):
    df = spark.createDataFrame([(10.0,), (-5.0,), (30.0,)], "price_usd double")
    c = _checks(df, Q.DatasetRules((), ("price_usd",), 0.1, ()))
    assert c["Column 'price_usd' has no negative values"]["passed"] is False
    allnull = spark.createDataFrame([(None,), (None,)], "price_usd double")
    assert "Column 'price_usd' has no negative values" not in _checks(allnull, Q.DatasetRules((), ("price_usd",), 0.1, ()))


def test_zero_is_fine(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "vol double")
    assert _checks(df, Q.DatasetRules((), ("vol",), 0.1, ()))["Column 'vol' has no negative values"]["passed"] is True


def test_empty_table_fails_not_empty_and_null_ratio(spark):
    df = spark.createDataFrame([], "timestamp string, name string, last double")
    c = _checks(df, Q.STOCK_RULES)
    assert c["DataFrame not empty"]["passed"] is False
    assert c["Null ratio for 'last'"]["passed"] is False
    assert Q.overall(Q.validate_dataset(df, Q.STOCK_RULES, "s")).collect()[0]["passed"] is False


def test_non_numeric_column(spark):
    df = spark.createDataFrame([("1",), ("-2",)], "vol string")
    c = _checks(df, Q.DatasetRules((), ("vol",), 0.1, ()))
    assert c["Column 'vol' is numeric"]["passed"] is False
    assert "Column 'vol' has no negative values" not in c


def test_required_columns_and_order(spark):
    df = spark.createDataFrame([("a", 1.0)], "name string, last double")
    out = Q.validate_dataset(df, Q.STOCK_RULES, "s").orderBy("check_id").collect()
    assert out[0]["check_name"] == "DataFrame not empty"
    assert out[1]["check_name"] == "Required columns present" and out[1]["passed"] is False
    assert out[1]["observed"] == 1.0


def test_missing_assets(spark):
    from barline.config import Config, asset_frame

    cfg = Config(stocks=("A", "B"), cryptos=("C",))
    data = spark.createDataFrame([("A",), ("A",), ("C",)], "asset_name string")
    got = [r["asset_name"] for r in Q.missing_assets(asset_frame(spark, cfg), data).collect()]
    assert got == ["B"]


def test_checks_taken_while_writing_equal_the_plain_ones(spark):
    schema = "timestamp int, name string, last double, high string, extra long"
    rows = [(i % 7 if i % 5 else None, f"n{i % 3}", float(i - 4) if i % 4 else None, None, i) for i in range(200)]
    for data in (rows, rows[:1], [], [(1, "a", None, "x", 1)]):
        df = spark.createDataFrame(data, schema)
        shuffled = df.repartition(5, "extra")
        table, checks = Q.write_checked(shuffled, Q.STOCK_RULES, "s")
        plain = Q.validate_dataset(df, Q.STOCK_RULES, "s")
        assert sorted(map(tuple, checks.collect())) == sorted(map(tuple, plain.collect()))
        assert sorted(map(str, table.collect())) == sorted(map(str, df.collect()))


def test_write_checked_computes_the_dataset_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    df = spark.range(100).selectExpr("id AS timestamp", "'a' AS name", "cast(id AS double) AS last").mapInArrow(
        count, "timestamp long, name string, last double")
    _, checks = Q.write_checked(df, Q.STOCK_RULES, "once")
    assert checks.where("check_name = 'DataFrame not empty'").collect()[0]["observed"] == 100.0
    assert checks.count() > 0 and calls.value == 100
