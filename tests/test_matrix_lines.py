"""The lines of the model matrix: what is shuffled to their orders."""

from __future__ import annotations

import re

from marquee.suite import matrix_queries as m


def test_lines_come_back_from_their_number(spark, monkeypatch):
    """Odd quantities and costs, missing ones, and names that are null, with numbered names and without."""
    codes = [0, 3702, 64, 127]
    values = [0, 1, 1023, 1024, -1, 2**28 - 1, 2**28, 2**40, None]
    names = [("ring", "b1"), ("ring", None), (None, "b2"), (None, None)]
    rows = [
        (i * 100 + j * 10 + k, codes[k % 4], q, c, *names[(i + j + k) % 4])
        for i, q in enumerate(values) for j, c in enumerate(values) for k in range(4)
    ]
    lines = spark.createDataFrame(rows, "l_orderkey long, code int, q long, c long, name string, brand string")
    parts = spark.createDataFrame([*names, *names], "name string, brand string")
    for limit in (2**13, 1):
        monkeypatch.setattr(m, "MOST_LABELS", limit)
        labels = m._numbered(parts)
        assert (labels is None) == (limit == 1)
        got = m._dealt(lines, labels)
        assert got.columns == lines.columns and sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_lines_are_shuffled_without_their_names(spark):
    """The rows dealt by order are an order, a number and what has no room in it."""
    plan = m._titles(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    text = plan.toString()
    dealt = re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L?, \d+\), REPARTITION_BY_COL.*\n.*?Project \[(.*)\]\n", text)
    assert dealt and dealt[1].startswith("l_orderkey")
    assert re.findall(r" AS (\w+)#", dealt[1])[-2:] == ["packed", "wide"]
