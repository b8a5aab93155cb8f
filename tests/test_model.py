import datetime as dt

import pytest

from gridweave import model as M
from gridweave.functions.hashing import signed_xxh3


def test_curve_parsing():
    c = M.Curve.parse({"name": " A ", "curve_type": "instance", "data_type": "NONE", "categories": ["Wind Power", None, "On/Shore", "x"], "resolution": {"frequency": "None", "timezone": " "}, "place": {"areas": ["DE", ""], "location": [1, None, 2]}, "area": ""})
    assert (c.name, c.curve_type, c.data_type, c.area, c.resolution) == ("A", "INSTANCE", "NORMAL", None, M.Resolution())
    assert c.place.areas == ("DE",) and c.place.location == (1.0, 2.0)
    assert c.id == signed_xxh3("A") and M.Curve().id == 0
    assert c.table_name("Raw!") == "raw_normal_instance_wind_power_on_shore" and c.cluster_key() == "normal_instance"
    assert c.tags() == {"name": "A", "data_type": "NORMAL", "curve_type": "INSTANCE", "categories": "Wind Power,On/Shore,x"}
    assert M.Curve.parse(c) is c and c.is_instance and not c.is_period_instance


def test_bad_values():
    with pytest.raises(ValueError):
        M.Curve.parse({"curve_type": "odd"})
    with pytest.raises(TypeError):
        M.Curve.parse("x")
    with pytest.raises(TypeError):
        M.parse_part(M.Place, 3)


def test_times():
    utc = dt.timezone.utc
    assert M.utc_datetime("2025-01-01T00:00:00Z") == dt.datetime(2025, 1, 1, tzinfo=utc)
    assert M.utc_datetime(dt.datetime(2025, 1, 1)) == dt.datetime(2025, 1, 1, tzinfo=utc)
    assert M.utc_datetime(" ") is None
