"""Executors need not have barline installed: its objects pickle by value."""

import subprocess
import sys


def test_barline_objects_load_where_barline_is_not_importable(tmp_path):
    from pyspark import cloudpickle

    from barline.config import FeatureConfig
    from barline.functions.names import clean_name

    cfg = FeatureConfig()

    def kernel(x):
        return (cfg.macd_fast, clean_name(x))

    blob = tmp_path / "k.pkl"
    blob.write_bytes(cloudpickle.dumps(kernel))
    code = (
        "import pickle, sys\n"
        "assert not any('repo' in p for p in sys.path), sys.path\n"
        f"f = pickle.load(open({str(blob)!r}, 'rb'))\n"
        "print(f('Close Price'))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == str(kernel("Close Price"))
