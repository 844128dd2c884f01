import pytest
from conftest import rows

from tidegate.operators import quality
from tidegate.sources.rules import read_rules, rules_from_frame
from tidegate.spec import RuleSpec, SpecError


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "x"), (2, ""), (3, None), (None, " ")], "a int, b string")


def test_null_flag_takes_any_null_but_no_blank(df):
    flags = [row[quality.FLAG] for row in quality.flag_missing(df, ["a", "b"]).collect()]
    assert flags == [False, False, True, True]


def test_blank_can_count_as_null(df):
    flags = [row[quality.FLAG] for row in quality.flag_missing(df, ["b"], blank_is_null=True).collect()]
    assert flags == [False, True, True, True]


def test_blank_list_flags_nothing(df):
    for text in ("", "  ", None):
        columns = quality.parse_column_list(text)
        assert not any(row[quality.FLAG] for row in quality.flag_missing(df, columns).collect())


def test_column_list():
    assert quality.parse_column_list("a, b") == ("a", "b")
    assert quality.parse_column_list("a, b", trim=False) == ("a", " b")


def test_split_loses_no_row(df):
    good, bad = quality.split_rows(quality.flag_missing(df, ["b"]))
    assert good.columns == df.columns == bad.columns
    assert (good.count(), bad.count()) == (3, 1)


def test_metrics_and_observation_agree(df):
    flagged = quality.flag_missing(df, ["b"])
    assert tuple(quality.load_metrics(flagged).first()) == (4, 3, 1)
    observed, counts = quality.observe_load(flagged, "test load")
    observed.write.format("noop").mode("overwrite").save()
    assert counts.get == {"total_record_count": 4, "load_record_count": 3, "error_record_count": 1}


def test_metrics_of_no_rows(df):
    assert tuple(quality.load_metrics(quality.flag_missing(df.where("a > 99"), ["b"])).first()) == (0, 0, 0)


def test_rules_per_row_and_per_rule(df):
    rules = [RuleSpec(7, ("a",)), RuleSpec(3, ("b",), "Not Null"), RuleSpec(9, ("a", "b"))]
    got = [row.violated_rules for row in quality.check_rules(df, rules).collect()]
    assert got == [[], [], [3, 9], [7, 9]]
    assert rows(quality.count_violations(df, rules)) == [
        {"rule_id": 3, "violations": 1}, {"rule_id": 7, "violations": 1}, {"rule_id": 9, "violations": 2},
    ]
    assert [row.violated_rules for row in quality.check_rules(df, []).collect()] == [[]] * 4


def test_wrong_rules_are_refused(df):
    with pytest.raises(SpecError):
        quality.check_rules(df, [RuleSpec(1, ("nope",))])
    with pytest.raises(SpecError):
        quality.check_rules(df, [RuleSpec(1, ("a",), "unique")])


def test_rule_document(spark, write_file):
    path = write_file("rules.json", """{
      "dq_id": 5,
      "rules": [
        {"rule_id": 51, "name": "ids", "description": "ids are set", "rule_type": "not null", "columns": ["a", "b"]},
        {"rule_id": 52, "name": "none", "rule_type": "not null", "columns": []}
      ]
    }""")
    table = read_rules(spark, path, "job")
    assert table.count() == 3
    assert {row.job_id for row in table.collect()} == {"job"}
    rules = rules_from_frame(table)
    assert [(rule.rule_id, rule.columns, rule.rule_type) for rule in rules] == [
        (51, ("a", "b"), "not null"), (52, (), "not null"),
    ]
