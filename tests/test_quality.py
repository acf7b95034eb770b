from orebelt import (
    append_audit,
    append_stream,
    dq_report,
    expect_or_drop,
    observe_rules,
    observed_report,
    read_audit,
)

RULES = {"positive": "v > 0", "known": "k IS NOT NULL"}


def frame(spark):
    return spark.createDataFrame(
        [("a", 1), ("a", 0), ("a", None), (None, 5), (None, None)], "k string, v int"
    )


def test_a_null_outcome_fails_and_counts_add_up(spark):
    df = frame(spark)
    assert [tuple(r) for r in expect_or_drop(df, RULES).collect()] == [("a", 1)]
    report = [tuple(r) for r in dq_report(df, RULES).collect()]
    assert report == [("positive", 2, 3), ("known", 3, 2)]
    assert {p + d for _, p, d in report} == {5}


def test_no_rules_keep_everything(spark):
    assert expect_or_drop(frame(spark), {}).count() == 5


def test_report_over_nothing(spark):
    assert [tuple(r) for r in dq_report(frame(spark).filter("false"), RULES).collect()] == [
        ("positive", 0, 0),
        ("known", 0, 0),
    ]


def test_audit_replaces_a_repeated_run_and_keeps_the_others(spark, tmp_path):
    target = str(tmp_path / "audit")
    report = dq_report(frame(spark), RULES)
    for run in ("r1", "r2", "r2"):
        append_audit(report, target, run, "d1")
    append_audit(report, target, "r2", "d2")
    rows = sorted(tuple(r)[:3] for r in read_audit(spark, target).collect())
    assert rows == sorted(
        (run, dataset, rule)
        for run, dataset in (("r1", "d1"), ("r2", "d1"), ("r2", "d2"))
        for rule in RULES
    )


def test_observed_counts_cover_all_micro_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    for _ in range(4):
        frame(spark).coalesce(1).write.mode("append").parquet(source)
    stream = (
        spark.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1).parquet(source)
    )
    run = append_stream(
        expect_or_drop(observe_rules(stream, "rules", RULES), RULES),
        str(tmp_path / "out"),
        str(tmp_path / "progress"),
    )
    assert run.micro_batches == 4
    report = [tuple(r) for r in observed_report(spark, run.observed, "rules", RULES).collect()]
    assert report == [("positive", 8, 12), ("known", 12, 8)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_rule_names_are_free_text(spark):
    report = dq_report(frame(spark), {"is a.b known?": "k IS NOT NULL"})
    assert [tuple(r) for r in report.collect()] == [("is a.b known?", 3, 2)]
