"""Two variables of one source row."""

import pytest

from stayflow.operators import quality as Q


def pairs(spark, rows):
    return Q.paired(spark.createDataFrame(rows, "hospital_id string, row_ord long, variable string, value double"), "ecmo", "fio2")


def test_overlap(spark):
    rows = [("A", 1, "ecmo", 1.0), ("A", 1, "fio2", 40.0), ("A", 2, "ecmo", 0.0), ("A", 2, "fio2", 40.0), ("A", 3, "ecmo", 1.0), ("A", 3, "fio2", None), ("A", 4, "ecmo", None), ("A", 4, "fio2", 21.0), ("A", 4, "hr", 1.0), ("B", 1, "ecmo", 1.0)]
    rows += [("C", i, "fio2", float(i)) for i in range(12)]
    p = pairs(spark, rows)
    sites = spark.createDataFrame([("A",), ("B",), ("C",), ("D",), ("A",)], "hospital_id string")
    got = {r[0]: tuple(r)[1:] for r in Q.overlap_summary(p, sites).collect()}
    assert got["A"] == (True, True, 3, 3, 2, 1, 1, [0.0, 1.0], [21.0, 40.0]) and got["B"] == (True, False, 1, 0, 0, 0, 0, [1.0], [])
    assert got["C"] == (False, True, 0, 12, 0, 0, 0, [], [float(i) for i in range(10)]) and got["D"] == (False, False, 0, 0, 0, 0, 0, [], [])
    table = Q.overlap_crosstab(p)
    assert table.columns == ["hospital_id", "a", "b_40_00"] and sorted(map(tuple, table.collect())) == [("A", 0.0, 1), ("A", 1.0, 1)]


def test_no_overlap_and_too_many_values(spark):
    assert Q.overlap_crosstab(pairs(spark, [("A", 1, "ecmo", 1.0)])).collect() == []
    many = pairs(spark, [("A", i, v, float(i)) for i in range(5) for v in ("ecmo", "fio2")])
    with pytest.raises(ValueError):
        Q.overlap_crosstab(many, 4)
