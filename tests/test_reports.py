from hypothesis import given, settings
from hypothesis import strategies as st

from oxbow.operators import reports

CASES = [(1, "g1", "OK"), (2, "g1", "X"), (3, "g2", "X"), (4, None, "OK"), (None, "g3", "OK"),
         (5, "g4", "OK"), (6, "g4", "OK")]
GROUPS = [("g1", 10), ("g2", 5), ("g3", 7), ("g9", 1)]
EXPECTED = [  # nulls first: (group_name, all, passed, test_value, total_value)
    (None, 1, None, None, None),
    ("g2", 1, None, 5, None),
    ("g4", 2, 2, None, None),
    ("g3", 0, 0, 7, 0),
    ("g1", 2, 1, 10, 10),
]


def frames(spark, cases, groups):
    c = spark.createDataFrame(cases, "id int, group_name string, status string")
    g = spark.createDataFrame(groups, "name string, test_value int")
    return c, g


def test_report_rows_and_order(spark):
    c, g = frames(spark, CASES, GROUPS)
    out = reports.ordered_report(reports.group_pass_report(c, g)).orderBy("rn").collect()
    assert [tuple(r)[:5] for r in out] == EXPECTED
    assert [r.rn for r in out] == [1, 2, 3, 4, 5]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)),
                          st.sampled_from(["a", "b", "c", None]),
                          st.sampled_from(["OK", "X", None])), max_size=20),
       st.lists(st.tuples(st.sampled_from(["a", "b", "d", None]), st.integers(0, 3)), max_size=4))
def test_report_matches_plain_python(spark, cases, groups):
    c, g = frames(spark, cases, groups)
    want = []
    for name in {x[1] for x in cases}:
        mine = [x for x in cases if x[1] == name]
        ok = [x for x in mine if x[2] == "OK"]
        every = sum(x[0] is not None for x in mine)
        passed = sum(x[0] is not None for x in ok) if ok and name is not None else None
        values = [v for n, v in groups if n == name and name is not None] or [None]
        want += [(name, every, passed, v, None if v is None or passed is None else v * passed) for v in values]
    got = sorted(map(tuple, reports.group_pass_report(c, g).collect()), key=repr)
    assert got == sorted(want, key=repr)
