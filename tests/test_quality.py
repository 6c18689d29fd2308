from ledgerline.operators import quality as Q


def test_column_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "z")], "k bigint, v string")
    assert [r.k for r in Q.unique(df, "k").collect()] == [1]
    assert Q.not_null(df, "v").count() == 1
    assert [r.v for r in Q.accepted_values(df, "v", ["a", "b"]).collect()] == ["z"]
    parent = spark.createDataFrame([(1,)], "id bigint")
    assert [r.k for r in Q.relationships(df, "k", parent, "id").collect()] == [2]
    assert Q.accepted_range(df, "k", 0, 1).count() == 1


def test_row_count_delta_and_nonempty(spark):
    a = spark.range(120)
    b = spark.range(100)
    assert Q.row_count_delta(a, b, 10).count() == 1
    assert Q.row_count_delta(a, b.limit(0), 10).count() == 0  # empty comparison passes
    assert Q.nonempty(a).count() == 0 and Q.nonempty(a.limit(0)).count() == 1


def test_suite_report(spark):
    df = spark.createDataFrame([(1,), (1,)], "k bigint")
    rep = Q.run_suite([Q.Check("u", "m", "k", lambda: Q.unique(df, "k")),
                       Q.Check("n", "m", "k", lambda: Q.not_null(df, "k"), "warn")])
    got = {r.test_name: (r.n_failures, r.status) for r in rep.collect()}
    assert got == {"u": (1, "fail"), "n": (0, "pass")}


def test_stored_failures_of_a_test_that_passes_now_go(spark):
    import uuid

    from ledgerline.operators import quality as Q
    from ledgerline.session import path_exists, scratch_dir
    path = scratch_dir(spark, f"failures-{uuid.uuid4().hex}")
    table = spark.createDataFrame([(1,), (None,), (None,)], "a int")
    for rows, left in ((table, 2), (table.where("a = 1"), None)):
        checks = [Q.Check("not_null_a", "t", "a", lambda rows=rows: rows.where("a IS NULL"))]
        failed = Q.store_failures(checks, Q.run_suite(checks), path)
        assert failed == (["not_null_a"] if left else [])
        assert path_exists(spark, f"{path}/not_null_a") == bool(left)
