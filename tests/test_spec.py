import json

import pytest

from numprep import ColumnSpec, load_specs


def test_defaults():
    spec = ColumnSpec("a")
    assert (spec.min_val, spec.max_val, spec.clip_oor, spec.rounding) == (False, False, True, 6)
    assert (spec.prefix, spec.suffix, spec.clip, spec.reject) == ("", "", False, False)


def test_zero_and_one_are_numbers():
    spec = ColumnSpec("a", min_val=0, max_val=1)
    assert (spec.fixed_min, spec.fixed_max) == (0.0, 1.0)
    assert ColumnSpec("a", min_val=0.0).fixed_min == 0.0
    assert ColumnSpec("a", min_val=True).fixed_min is None


def test_text_bound_carries_the_affixes():
    assert ColumnSpec("a", prefix="$", min_val="$5").fixed_min == 5.0
    assert ColumnSpec("a", suffix="cm", max_val="1.5cm").fixed_max == 1.5
    for bad in ("5", "$x", "$", "$1_0", "$nan"):
        with pytest.raises(ValueError):
            ColumnSpec("a", prefix="$", min_val=bad)


@pytest.mark.parametrize(
    "settings",
    [
        {"min_val": 3, "max_val": 2},
        {"min_val": float("nan")},
        {"min_val": None},
        {"rounding": 1.5},
        {"rounding": True},
        {"clip": 1},
        {"prefix": None},
    ],
)
def test_bad_settings(settings):
    with pytest.raises(ValueError):
        ColumnSpec("a", **settings)


def test_infinite_bound_is_no_bound():
    assert ColumnSpec("a", min_val=float("-inf")).min_val is False


def test_config_keeps_order_and_reports_unknown_names():
    config = {"b": {"converter": {"min_val": 1}, "normalizer": {"clip": True}}, "a": None}
    specs = load_specs(config)
    assert [s.column for s in specs] == ["b", "a"]
    assert specs[0].clip and specs[0].fixed_min == 1.0
    assert [s.column for s in load_specs(config, columns=["a"])] == ["a"]
    with pytest.raises(ValueError, match="not configured: z"):
        load_specs(config, columns=["z"])
    for bad in ({"a": {"converter": {"clip": True}}}, {"a": {"normaliser": {}}}):
        with pytest.raises(ValueError, match="unknown"):
            load_specs(bad)
    with pytest.raises(ValueError, match="twice"):
        load_specs([ColumnSpec("a"), ColumnSpec("a")])


def test_config_files(tmp_path):
    yaml_file, json_file = tmp_path / "c.yaml", tmp_path / "c.json"
    yaml_file.write_text("h:\n  converter:\n    min_val: 1\n    max_val: False\n    suffix: 'cm'\n")
    json_file.write_text(json.dumps({"h": {"converter": {"min_val": 1, "max_val": False, "suffix": "cm"}}}))
    assert load_specs(yaml_file) == load_specs(str(json_file)) == [ColumnSpec("h", min_val=1, suffix="cm")]
