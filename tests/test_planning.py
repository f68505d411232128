import datetime as dt

import pytest

from nimbria.functions import geo
from nimbria.model import Step, coordinates
from nimbria.operators import cluster as K
from nimbria.plans import requests as Q
from nimbria.plans import schema as S
from nimbria.plans import windows as W


def test_steps():
    assert Step.parse("0-24") == Step(0, 24) and str(Step.parse(6)) == "6" and Step(0, 24).width == 24
    assert sorted([Step(0, 24), Step(12, 12), Step(12, 24)]) == [Step(12, 12), Step(0, 24), Step(12, 24)]
    with pytest.raises(ValueError):
        Step.parse("24-0")


def test_coordinates():
    assert coordinates([{"from": 0, "to": 12, "by": 6}, 15]) == [0, 6, 12, 15] and coordinates({"to": 2}) == [0, 1, 2]


def test_months():
    assert W.month_ranges(dt.date(2023, 1, 15), 0, 24 * 80) == [Step(408, 1080), Step(1080, 1824)]
    assert W.forecast_month(dt.date(2023, 1, 1), Step(744, 1416)) == 2
    with pytest.raises(ValueError):
        W.forecast_month(dt.date(2023, 1, 1), Step(0, 720))


def test_windows():
    assert [w.window_id for w in W.step_ranges(0, 48, 24, 12)] == ["0-24", "12-36", "24-48"]
    with pytest.raises(ValueError):
        W.infer_operation("=")
    windows, thresholds = W.threshold_windows([{"coords": {"to": 2}, "thresholds": [{"comparison": "<", "value": 1}, {"comparison": ">", "value": 2}], "std": True}])
    assert [w.window_id for w in windows] == ["std_0-2_minimum", "std_0-2_maximum"] and len(thresholds) == 2
    with pytest.raises(ValueError):
        W.threshold_windows([{"coords": 1, "thresholds": []}])
    with pytest.raises(ValueError):
        W.Window("w", (1,), "median")
    days = [dt.date(2024, 1, d) for d in (1, 4, 8, 11)]
    assert W.date_sequence(days, dt.date(2024, 1, 8), 2, 1) == [days[1], days[2], days[3]]
    assert len(W.model_steps()) == 91 + 18 + 17


def test_requests():
    r = {"step": [0, 6], "param": "t", "number": [1, 2]}
    assert len(Q.expand(r)) == 4 and Q.expand(r, ["step"])[1] == {"step": 6, "param": "t", "number": [1, 2]}
    assert Q.squeeze(Q.expand(r), ["step", "number"]) == [{"param": "t", "step": [0, 6], "number": [1, 2]}]
    assert Q.deep_update({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert Q.update_request([{"a": 1}, {"a": 2}], {"b": 3}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]
    with pytest.raises(ValueError):
        Q.update_request([{}], [{}, {}])
    assert Q.dict_product({"a": [1, 2], "b": [3, 4]})[1] == {"a": 1, "b": 4}
    text = Q.serialise("retrieve", {"step": range(0, 13, 6), "date": dt.date(2024, 5, 1), "param": ["t", "u"]})
    assert "step=0/to/12/by/6" in text and "date=20240501" in text and "param=t/u" in text
    assert Q.parse_values("0/to/12/by/6") == [0, 6, 12] and Q.parse_values("1-3,7") == [1, 2, 3, 7] and Q.parse_values("t/u") == ["t", "u"]
    assert Q.common_requests([{"a": 1}], [{"a": 2}]) == [] and Q.common_requests([{"a": 1}, {"a": 3}], [{"a": 1}]) == []
    assert Q.common_requests([{"a": 1, "number": 7}, {"a": 1}], [{"a": 1, "b": 2}, {"a": 1, "number": 4}, {"a": 2}]) == [{"a": 1, "b": 2}, {"a": 1, "number": 4}]


RULES = {
    "config": {"filter:type": {"em/es": {"tool": "ensms"}, "pb": {"tool": "prob", "filter:param": {"131": {"threshold": 1.0}, "*": {"threshold": 2.0}}}}},
    "inputs": {"filter:type": {"em/es": {"sources": [{"type": "pf", "number": [1, 2]}, {"type": "cf"}], "steps": {"by": 6}}, "*": {"sources": [{"type": "pf"}], "steps": {"by": 12, "deaccumulate": True, "available": {"to": 48, "by": 12}}}}},
}


def test_schema():
    assert S.traverse(RULES["config"], {"type": "pb", "param": "131"}) == {"tool": "prob", "threshold": 1.0}
    with pytest.raises(ValueError):
        S.traverse(RULES["config"], {"type": "fc"})
    schema = S.Schema(RULES)
    assert schema.inputs_for({"type": "em", "param": "130", "step": "0-12"})[0] == {"type": "pf", "param": "130", "number": [1, 2], "step": [6, 12]}
    assert schema.inputs_for({"type": "pb", "param": "131", "step": "12-36"})[0]["step"] == [12, 24, 36]
    jobs = schema.from_outputs([{"type": "em", "param": "130", "step": "0-12"}, {"type": "em", "param": "130", "step": "12-24"}])
    assert len(jobs) == 1 and len(jobs[0].windows) == 2
    have = [{"type": "pf", "param": "130", "number": [1, 2], "step": [6, 12]}, {"type": "cf", "param": "130", "step": [6, 12]}]
    assert schema.from_inputs(have, [{"type": "em", "param": "130", "step": "0-12"}, {"type": "em", "param": "130", "step": "12-24"}]) == [{"type": "em", "param": "130", "step": "0-12"}]
    assert sorted(k["type"] for k, _ in S.enumerate_outputs(RULES["config"], {"tool": "ensms"})) == ["em", "es"]
    assert S.climatology_step("24-48", [Step(0, 24), Step(12, 36)]) == Step(0, 24)
    assert S.output_steps([0, 6, 12, 18, 24], "range", 12, 6) == [Step(0, 12), Step(6, 18), Step(12, 24)]
    assert S.quantile_list(["3:100", "1:4"]) == [0.03, 0.25]


def test_scalars():
    assert K.season("10-4") == [10, 11, 12, 1, 2, 3, 4] and K.season_name(K.season("5-9")) == "MJJAS"
    assert geo.truncation_to_gaussian(1279, 1) == 640 and geo.gaussian_to_truncation(640, 1) == 1279 and geo.gaussian_to_truncation(640, 3) == 639
    assert geo.overlap_spacing(100.0, 1.0) == pytest.approx(0, abs=1e-6) and geo.overlap_spacing(100.0, 0.0) == pytest.approx(200)
    with pytest.raises(ValueError):
        K.choose_components([10.0, 20.0], 50)
    assert K.choose_partition({2: 90.0, 3: 99.0, 4: 99.0}, 95) == 3 and K.choose_partition({2: 10.0}, 95) == 1


def test_legacy_windows():
    """Lists are coordinates as they are, ids carry the window's number and, if it has several, the operation. Ids and header
    values are fixed: other programs look outputs up by them."""
    w, t = W.legacy({"windows": [{"coords": [[0], [0, 3], [300, 306], {"from": 6, "to": 12, "by": 3}]}]}, {"expver": "1"})
    assert [(x.window_id, x.coords, x.op) for x in w] == [("0_0", (0,), "aggregation"), ("0-3_0", (3,), "aggregation"), ("300-306_0", (306,), "aggregation"), ("6-12_0", (9, 12), "aggregation")]
    assert w[0].meta == {"expver": "1", "timeRangeIndicator": 1, "step": "0"} and w[1].meta == {"expver": "1", "stepType": "max", "stepRange": "0-3"}
    assert w[2].meta["unitOfTimeRange"] == 11 and all(x.sequential for x in w) and not t
    w, _ = W.legacy({"windows": [{"operation": "difference", "coords": [[0, 6], [3, 9]], "metadata": {"stepType": "diff"}}, {"operation": "mean", "coords": [["0-24"]]}, {"operation": "difference_rate", "factor": 2, "coords": [[0, 6]]}]})
    assert [(x.window_id, x.coords) for x in w] == [("0-6_0", (0, 6)), ("3-9_0", (3, 9)), ("0-24_1", ("0-24",)), ("0-6_2", (0, 6))]
    assert w[0].meta["stepType"] == "diff" and w[3].factor == 2 and w[2].meta == {"stepType": "max", "stepRange": "0-24"}
    limits = [{"comparison": "<=", "value": "1"}, {"comparison": ">", "value": 5}]
    w, t = W.legacy({"windows": [{"coords": [[12]]}], "std_anomaly_windows": [{"coords": [[0, 6, 12]], "thresholds": limits, "include_start": True}]})
    assert [(x.window_id, x.coords, x.op) for x in w] == [("12_0", (12,), "aggregation"), ("std_0-12_minimum_0", (0, 6, 12), "minimum"), ("std_0-12_maximum_0", (0, 6, 12), "maximum")]
    assert t == [{"window_id": "std_0-12_minimum_0", "comparison": "<=", "threshold": 1.0}, {"window_id": "std_0-12_maximum_0", "comparison": ">", "threshold": 5.0}]
    with pytest.raises(ValueError):
        W.legacy({"windows": [{"coords": [[1]], "thresholds": [{"comparison": "==", "value": 1}]}]})
