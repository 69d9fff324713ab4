import pytest

from landpulse import params
from landpulse.params import Composite, Disturbance, Trend


def test_recovery_profile():
    run = Composite(profile="spectral_recovery", years=(2020,), season_start="04-01", season_end="06-30", mode="monthly", payload="both").for_profile().check()
    assert (run.mode, run.payload, run.bands()) == ("yearly", "reflectance", ["B02", "B03", "B04", "B08", "B11", "B12"])
    (period,) = run.periods()
    assert period == {"label": "2020_0401_0630", "start": "2020-04-01", "end": "2020-06-30", "time_label": "2020-04-01"}
    assert run.output_name(period["label"]) == "2020.tif"


def test_sen_profile():
    run = Composite(profile="seasonal_sen", years=(2020, 2021), months=(6, 7)).for_profile().check()
    assert [p["label"] for p in run.periods()] == ["2020_06", "2020_07", "2021_06", "2021_07"]
    assert run.periods()[0]["end"] == "2020-06-30" and run.payload == "indices"


def test_breaks_profile():
    assert Composite(profile="breaks", indices=()).for_profile().check().indices == ("SAVI",)
    assert Composite(profile="breaks", indices=("NBR", "SAVI")).for_profile().check().indices == ("NBR",)


@pytest.mark.parametrize(
    "bad",
    [
        {"mode": "weekly"},
        {"indices": ("EVI",)},
        {"mode": "monthly", "months": ()},
        {"mode": "monthly", "months": (13,)},
        {"savi_l": -1},
        {"indices": ("TCW",), "tcw": {"B02": 1.0}},
        {"payload": "all"},
        {"profile": "other"},
        {"weights": (-1, 1, 1)},
        {"weights": (0, 0, 0)},
        {"profile": "spectral_recovery", "payload": "indices"},
        {"profile": "seasonal_sen"},
        {"profile": "breaks", "indices": ("NBR", "SAVI")},
    ],
)
def test_composite_is_checked(bad):
    with pytest.raises(ValueError):
        Composite(**bad).check()


def test_metric_names():
    assert params.metric_names(["R80P", "Delta IR", "pct-change", "r80p"]) == ["r80p", "deltair", "percent_change"]
    assert Trend().check().metrics == ("r80p", "deltair")
    for bad in ([], ["unknown"]):
        with pytest.raises(ValueError):
            params.metric_names(bad)
    assert params.recovery_metric("deltair") == "deltaIR"
    with pytest.raises(ValueError):
        params.recovery_metric("x")


def test_ranges():
    out = params.range_defaults({"rangestart": "2018-01-01", "rangeend": "2023-06-01", "metric_timestep": 2})
    assert out["years"] == [2018, 2019, 2020, 2021, 2022, 2023] and out["metric_timestep"] == 2 and out["sr_dist_rest_years"] == {0: [2018, 2019]}
    assert params.range_defaults({"a": 1}) == {"a": 1}
    with pytest.raises(ValueError):
        params.range_defaults({"rangestart": "2018", "rangeend": "2019"})


@pytest.mark.parametrize("bad", [{"filter_size": 4}, {"filter_size": True}, {"mmu": 0}, {"mmu": float("nan")}, {"connectivity": 6}, {"weights": (1.0, 2.0)}])
def test_disturbance_is_checked(bad):
    with pytest.raises(ValueError):
        Disturbance(**bad).check()


def test_feature_collection():
    polygon = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    whole = params.feature_collection(polygon)
    assert whole["features"][0]["geometry"] == polygon and params.feature_collection(whole) == whole
    with pytest.raises(ValueError):
        params.feature_collection({"type": "Point"})
