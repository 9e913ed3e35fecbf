"""Validation of enriched rows: each check on a row made for it, and the row-local form."""

import pytest

from jobloom.functions import vocab as V
from jobloom.operators.validate import ValidationError, assert_valid, label_violations, violations

PRODUCER = "Index long, `Position title` string"
ENRICHED = PRODUCER + ", complexity_score {}, category string, seniority_level string"
GOOD = (7, "Baker", 41, "Design", "Senior")


def _rules(spark, producer, enriched, score="int"):
    p = spark.createDataFrame(producer, PRODUCER)
    e = spark.createDataFrame(enriched, ENRICHED.format(score))
    return sorted(((r["Index"], r["rule_no"]) for r in violations(p, e).collect()), key=lambda x: (x[0] is not None, x))


def _with(**changes):
    row = dict(zip(("index", "title", "score", "category", "seniority"), GOOD)) | changes
    return tuple(row.values())


@pytest.mark.parametrize("row, found", [
    (GOOD, []),
    (_with(title="\u2003Baker\n"), []),
    (_with(title="Butcher"), [(7, 3)]),
    (_with(title="baker"), [(7, 3)]),
    (_with(score=0), []), (_with(score=100), []),
    (_with(score=-1), [(7, 5)]), (_with(score=250), [(7, 5)]), (_with(score=None), [(7, 4)]),
    (_with(category="\t"), [(7, 6)]), (_with(category="Astronomy"), [(7, 7)]), (_with(category=" Design "), [(7, 7)]),
    (_with(category=None), [(7, 7)]),
    (_with(seniority=""), [(7, 8)]), (_with(seniority=" Senior"), [(7, 9)]), (_with(seniority="senior"), [(7, 9)]),
    (_with(score=101, category="", seniority="Chief"), [(7, 5), (7, 6), (7, 9)]),
])
def test_each_check(spark, row, found):
    assert _rules(spark, [GOOD[:2]], [row]) == found


def test_scores_that_are_not_numbers(spark):
    assert _rules(spark, [GOOD[:2]], [_with(score=float("nan"))], "double") == [(7, 4)]
    assert _rules(spark, [GOOD[:2]], [_with(score="high")], "string") == [(7, 4)]
    assert _rules(spark, [GOOD[:2]], [_with(score=" 12.5 ")], "string") == []
    e = spark.createDataFrame([_with(score=float("nan"))], ENRICHED.format("double"))
    assert [r["rule_no"] for r in label_violations(e).collect()] == [4]


def test_rows_lost_and_added(spark):
    assert _rules(spark, [GOOD[:2], (8, "Miller")], [GOOD]) == [(None, 1), (8, 2)]
    assert _rules(spark, [GOOD[:2]], [GOOD, _with(index=9)]) == [(None, 1), (9, 2)]
    assert _rules(spark, [], []) == []


def test_repeated_and_missing_indexes_match_row_by_row(spark):
    twice = [(7, "Baker"), (7, "Miller"), (None, "Tanner"), (None, "Tanner")]
    rows = [(i, t, *GOOD[2:]) for i, t in reversed(twice)]
    assert _rules(spark, twice, rows) == []
    assert _rules(spark, twice, rows[1:]) == [(None, 1), (None, 2)]
    assert _rules(spark, twice, [*rows[:3], (7, "Cooper", *GOOD[2:])]) == [(7, 3)]


def test_half_of_all_rows_without_an_index(spark):
    """A hot null Index cancels in the aggregation; what is left of it is paired row by row."""
    rows = [(None if i % 2 else i, f"title {i % 37}") for i in range(2000)]
    good = [(i, t, *GOOD[2:]) for i, t in rows]
    assert _rules(spark, rows, good[::-1]) == []
    damaged = [(i, "other" if k in (1, 4, 5) else t, *rest) for k, (i, t, *rest) in enumerate(good) if k not in (3, 8)]
    assert _rules(spark, rows, damaged) == [(None, 1), (None, 2), (None, 3), (None, 3), (4, 3), (8, 2)]
    p, e = spark.createDataFrame(rows, PRODUCER), spark.createDataFrame(good, ENRICHED.format("int"))
    plan = violations(p, e)._jdf.queryExecution().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan and "FullOuter" not in plan
    assert _rules(spark, [], good[:1]) == [(None, 1), (0, 2)]


def test_first_failing_check_is_raised(spark):
    p = spark.createDataFrame([GOOD[:2]], PRODUCER)
    bad = spark.createDataFrame([_with(score=777, seniority="Chief")], ENRICHED.format("int"))
    with pytest.raises(ValidationError, match="outside 0 to 100"):
        assert_valid(p, bad)
    with pytest.raises(ValidationError, match="lack 'category'"):
        assert_valid(p, bad.drop("category"))
    assert_valid(p, spark.createDataFrame([GOOD], ENRICHED.format("int")))


def test_row_local_form_agrees(spark):
    rows = [_with(index=i, score=s, category=c) for i, (s, c) in enumerate([(5, "Design"), (None, "Design"), (500, " "), (5, "Law")])]
    e = spark.createDataFrame(rows, ENRICHED.format("int"))
    local = sorted((r["Index"], r["rule_no"]) for r in label_violations(e).collect())
    assert local == _rules(spark, [r[:2] for r in rows], rows) == [(1, 4), (2, 5), (2, 6), (3, 7)]


def test_good_row_uses_allowed_labels():
    assert GOOD[3] in V.ALLOWED_CATEGORIES and GOOD[4] in V.ALLOWED_SENIORITY
