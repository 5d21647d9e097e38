import datetime

import pytest

from pluvia.sources import units as U

D = datetime.date


def test_names_whatever_their_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], "TIME int, Lat int, x int")
    assert U.rename_columns(df, {"time": "issue", "LAT": "latitude", "gone": "y"}).columns == ["issue", "latitude", "x"]


def test_weights_and_their_checks(spark, tmp_path):
    (tmp_path / "w.csv").write_text("source_id,target_id,weight\n007, a ,0.5\n8,a,0\n9,b,2\n")
    assert sorted(map(tuple, U.read_cell_transform(spark, f"file://{tmp_path}/w.csv").collect())) == [("007", "a", 0.5), ("9", "b", 2.0)]
    make = lambda rows: U.cell_transform(spark.createDataFrame(rows, "source_id string, target_id string, weight string"))
    for rows, why in (([("1", "a", "-1")], "finite"), ([("1", "a", "x")], "finite"), ([("1", "a", "NaN")], "finite"), ([(None, "a", "1")], "ids"), ([("1", "a", "1"), (" 1", "a", "2")], "several"), ([("1", "a", "0")], "without")):
        with pytest.raises(ValueError, match=why):
            make(rows)
    assert make([]).count() == 0


def test_regrid_weights_agree_on_their_target(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a ", 0.5), (1.0, 3.0, "a", 0.5)], "lat double, lon double, adm3_name string, weight double")
    assert [tuple(r) for r in U.regrid_weights(df).orderBy("longitude").collect()] == [(1.0, 2.0, "a", 0.5), (1.0, 3.0, "a", 0.5)]
    both = spark.createDataFrame([(1.0, 2.0, "a", "b", 0.5)], "lat double, lon double, target_id string, adm3_name string, weight double")
    for bad, why in ((both, "disagree"), (df.unionByName(df), "repeated"), (df.drop("lat"), "missing"), (df.drop("adm3_name"), "need")):
        with pytest.raises(ValueError, match=why):
            U.regrid_weights(bad)


def test_reference_onsets_by_unit_and_year(spark):
    df = spark.createDataFrame([("u ", 2001, 14, "2001-05-20"), ("u ", 2001, 14, "2001-05-20"), ("v", 2002, None, None), ("v", 2003, 0, "2003-06-01")], "name string, Year int, MOK int, at string")
    of = lambda **more: sorted(map(tuple, U.reference_onsets(df, **more).collect()))
    assert of(unit="name", year="Year", day="MOK") == [("u", 2001, D(2001, 5, 15)), ("v", 2003, D(2003, 5, 1))]
    assert of(unit="name", date="at") == [("u", D(2001, 5, 20)), ("v", D(2003, 6, 1))]
    assert of(year="Year", day="MOK", first_year=2002) == [(2003, D(2003, 5, 1))]
    for wrong in ({"date": "at"}, {"unit": "name", "day": "MOK"}, {"unit": "name", "day": "MOK", "date": "at", "year": "Year"}):
        with pytest.raises(ValueError):
            U.reference_onsets(df, **wrong)
    with pytest.raises(ValueError, match="several"):
        U.reference_onsets(df.unionByName(df.limit(1).replace("2001-05-20", "2001-05-21")), unit="name", date="at")


def test_gridded_thresholds_and_observed_onsets(spark, tmp_path):
    cells = spark.createDataFrame([(1.25, 2.0, 10.0), (1.25, 2.0, 20.0), (1.5, 2.0, None)], "lat double, lon double, thr double")
    assert [tuple(r) for r in U.grid_thresholds(cells, "thr").collect()] == [("1.25_2", 15.0)]
    (tmp_path / "on.csv").write_text("id,true_onset\n01,3/6/2025\n01,3/6/2025\n2,NaT\n3,\n4,15/6/2025\n")
    assert sorted(map(tuple, U.read_onsets(spark, f"file://{tmp_path}/on.csv").collect())) == [("01", D(2025, 6, 3)), ("4", D(2025, 6, 15))]
