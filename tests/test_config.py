import json

import pytest

from barline.config import Config, load_params, override_params, save_params


def test_override_params_casts_and_keeps_rest():
    cfg = Config()
    out = override_params(cfg, {"lstm_units": 80.0, "xgb_lr": 0.1, "xgb_max_depth": 3.0})
    assert out.lookback.units == 80 and isinstance(out.lookback.units, int)
    assert out.boost.learning_rate == 0.1 and out.boost.max_depth == 3
    assert out.lookback.dropout == cfg.lookback.dropout and out.boost.n_estimators == cfg.boost.n_estimators


def test_from_dict_and_defaults():
    cfg = Config.from_dict({"assets": {"stocks": ["AMZN"]}, "features": {"lags": [1]},
                            "model_params": {"lstm": {"look_back": 5}}})
    assert cfg.stocks == ("AMZN",) and cfg.cryptos == ()
    assert cfg.features.lags == (1,) and cfg.lookback.look_back == 5
    assert Config.from_dict({}).assets == ()


def test_params_roundtrip(tmp_path):
    p = tmp_path / "best.json"
    save_params({"lstm_units": 55, "lstm_dropout": 0.2, "xgb_max_depth": 3}, p)
    got = json.loads(p.read_text())
    assert got == {"lstm_units": 55, "lstm_dropout": 0.2, "xgb_max_depth": 3}
    assert load_params(tmp_path / "missing.json") == {}


def test_the_library_gives_no_broadcast_hints():
    """Joins are left to the planner and AQE; only the bounded tables of the training-data operators carry a hint."""
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent / "barline"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "broadcast(" not in path.read_text(), path


def test_scratch_needs_a_shared_folder_off_local_mode():
    from types import SimpleNamespace

    from barline.session import ensure_checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(conf={}, sparkContext=context))
