"""Quality checks (V1–V5): one table of frames with the exact report each gives."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkmart.operators import quality as Q

NAN = float("nan")
PARCELS = "parcel long, weight double, depot string"


def empty(name):
    return Q.MSG_EMPTY.format(name=name)


def copies(name, n):
    return Q.MSG_DUPLICATES.format(name=name, n=n)


def gaps(name, *columns):
    return Q.MSG_NULL_COLUMNS.format(name=name, columns=", ".join(columns))


def refused(name, ratio, threshold):
    return Q.MSG_NULL_RATIO.format(name=name, ratio=ratio, threshold=threshold)


# (schema, rows, threshold, messages, accepted)
REPORTS = {
    "no columns": ("struct<>", [], 0.3, [empty("depot")], False),
    "columns without rows": (PARCELS, [], 0.3, [empty("depot")], False),
    "nothing to say": (PARCELS, [(4, 0.5, "N"), (5, 0.5, "N")], 0.0, [], True),
    "a row three times": (PARCELS, [(4, 1.5, "N")] * 3 + [(9, 1.5, "N")], 0.3, [copies("depot", 2)], True),
    "null rows repeat too": (
        PARCELS, [(1, 2.0, "S")] * 2 + [(None, None, None)] * 2 + [(n, 1.0, "E") for n in range(6)], 0.3,
        [copies("depot", 2), gaps("depot", "parcel", "weight", "depot")], True,
    ),
    "at the threshold": (
        "a long, b string", [(None, "q"), (None, "r"), (None, "s"), (7, "t"), (8, "u")], 0.3,
        [gaps("depot", "a")], True,
    ),
    "above a lower threshold": (
        "a long, b string", [(None, "q"), (None, "r"), (None, "s"), (7, "t"), (8, "u")], 0.25,
        [gaps("depot", "a"), refused("depot", 0.3, 0.25)], False,
    ),
    "not a number is missing": (
        PARCELS, [(1, NAN, "N"), (2, NAN, None)], 0.4,
        [gaps("depot", "weight", "depot"), refused("depot", 0.5, 0.4)], False,
    ),
    "all three messages in order": (
        "a long, b string", [(None, "q"), (None, "q"), (3, None)], 0.3,
        [copies("depot", 1), gaps("depot", "a", "b"), refused("depot", 0.5, 0.3)], False,
    ),
}


@pytest.mark.parametrize("case", REPORTS)
def test_report(spark, case):
    schema, rows, threshold, messages, accepted = REPORTS[case]
    frame = spark.createDataFrame(rows, schema)
    assert Q.validate_dataframe(frame, "depot", threshold) == (messages, accepted)
    report = Q.validate(frame, "depot", threshold)
    assert report.n_rows == len(rows) and report.as_tuple() == (messages, accepted)


@given(
    st.lists(
        st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, 0.0, -0.0, NAN]), st.sampled_from([None, "", "z"])),
        min_size=1, max_size=12,
    )
)
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_counts_equal_plain_counting(spark, rows):
    def plain(v):
        return "NaN" if v != v else v + 0.0 if isinstance(v, float) else v

    report = Q.validate(spark.createDataFrame(rows, PARCELS), "any")
    missing = [sum(r[i] is None or r[i] != r[i] for r in rows) for i in range(3)]
    assert report.null_counts == missing
    assert math.isclose(report.null_ratio, sum(missing) / (3 * len(rows)))
    seen = Counter(tuple(map(plain, r)) for r in rows)
    assert report.duplicate_rows == sum(n - 1 for n in seen.values())


def test_nested_values_are_compared(spark):
    rows = [({"k": 1}, [1, 2]), ({"k": 1}, [1, 2]), ({"k": 2}, None)]
    s = Q.quality_summary(spark.createDataFrame(rows, "m map<string,int>, a array<int>")).first()
    assert (s["n_rows"], s["duplicate_rows"]) == (3, 1)
