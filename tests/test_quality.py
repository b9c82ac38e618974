from tallymart.plans import quality

EXPECTED = {"t": {"id": "object", "n": "int64", "x": "float64", "gone": "object"}, "absent": {"id": "object"}}


def found(df):
    return {(r["table"], r["check"]): (r["status"], r["detail"]) for r in df.collect()}


def test_schema_rows(spark):
    df = spark.createDataFrame([("a", "1", "1.5", 1), ("b", None, "2", 2)], "id string, n string, x string, more int")
    assert found(quality.check_schemas({"t": df}, EXPECTED)) == {
        ("t", "MISSING_COLS"): ("FAIL", "{'gone'}"),
        ("t", "EXTRA_COLS"): ("INFO", "{'more'}"),
        ("t", "DTYPE_n"): ("WARN", "Expected int64, got float64"),  # a gap in a column of whole numbers
        ("absent", "SCHEMA"): ("FAIL", "File not loaded"),
    }


def test_null_rows_and_empty_table(spark):
    df = spark.createDataFrame([(i if i % 3 else None, "x") for i in range(3000)], "a int, b string")
    assert found(quality.check_nulls({"t": df})) == {("t", "NULLS_a"): ("INFO", "1,000 nulls (33.3%)")}
    assert found(quality.check_nulls({"t": df.limit(0)})) == {}


def test_key_rows_count_every_row_of_a_shared_key(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "id int")
    assert found(quality.check_primary_keys({"t": df}, {"t": ["id"], "absent": ["id"]})) == {
        ("t", "PRIMARY_KEY"): ("FAIL", "PK=['id'], duplicates=5")}


def test_reference_rows(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    keys = {"child": [("k", "parent", "id"), ("k", "absent", "id")]}
    assert found(quality.check_foreign_keys({"child": child, "parent": parent}, keys)) == {
        ("child", "FK_k→parent.id"): ("WARN", "2 orphan values out of 3 unique"),
        ("child", "FK_k"): ("SKIP", "Parent table absent not loaded"),
    }


def test_duplicate_rows_treat_missing_values_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (1, "x")], "a int, b string")
    assert found(quality.check_duplicates({"t": df, "e": df.limit(0)})) == {
        ("t", "DUPLICATES"): ("WARN", "2 duplicate rows out of 4"),
        ("e", "DUPLICATES"): ("PASS", "0 duplicate rows out of 0"),
    }


def test_summary_and_failures(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    report = quality.quality_report({"t": df}, {"t": {"id": "int64"}}, {"t": ["id"]}, {"x": []})
    assert {r["status"]: r["checks"] for r in quality.status_counts(report).collect()} == {"PASS": 1, "FAIL": 1, "WARN": 1}
    assert [r["check"] for r in quality.failures(report).collect()] == ["PRIMARY_KEY"]
