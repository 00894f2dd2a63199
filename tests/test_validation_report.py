"""The validation report against numbers counted by hand."""

from ashgrid.plans import validation as V

ROWS = [(1, 1, 49.0, -123.0), (1, 3, 49.0, -123.0), (3, 4, 55.0, -120.0), (3, 3, 52.0, -120.0), (5, 2, 52.0, -120.0)]
COLUMNS = "y int, prediction_level int, lat double, lon double"


def test_report_sections(spark, tmp_path):
    got = V.write_report(spark.createDataFrame(ROWS, COLUMNS), str(tmp_path), "y")
    s = {(r.section, r.key): r for r in got["summary"].collect()}
    every = s["overall", "all"]
    assert (every.n, every.exact, every.within_one) == (5, 0.4, 0.6) and abs(every.bias - 0.0) < 1e-12
    assert {k[1]: (r.n, r.bias, r.direction) for k, r in s.items() if k[0] == "region"} == {
        "coast/SW": (2, 1.0, "over-calls"), "north": (1, 1.0, "over-calls"), "interior": (2, -1.5, "under-calls")}
    assert {k[1]: (r.n, r.mean_pred, r.pct_high_plus) for k, r in s.items() if k[0] == "official"} == {
        "1": (2, 2.0, 50.0), "3": (2, 3.5, 100.0), "5": (1, 2.0, 0.0)}
    confusion = {r.official: (r.n, r.pct_1, r.pct_2, r.pct_3, r.pct_4, r.pct_5) for r in got["confusion"].collect()}
    assert confusion == {1: (2, 50.0, 0.0, 50.0, 0.0, 0.0), 3: (2, 0.0, 0.0, 50.0, 50.0, 0.0), 5: (1, 0.0, 100.0, 0.0, 0.0, 0.0)}


def test_report_of_no_rows(spark, tmp_path):
    got = V.write_report(spark.createDataFrame([], COLUMNS), str(tmp_path), "y")
    assert got["summary"].filter("section <> 'overall'").count() == 0 and got["confusion"].count() == 0
