"""The checkpoint folder comes from the session; a scratch folder is made
only when nothing is configured."""

import os
import subprocess
import sys


def test_configured_checkpoint_dir_is_used(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shared = str(tmp_path / "shared-ckpt")
    code = (f"import sys; sys.path.insert(0, {repo!r})\n"
            "from pyspark.sql import SparkSession\n"
            "from tabula.session import ensure_checkpoint_dir, scratch_path\n"
            f"s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
            f".config('spark.checkpoint.dir', {shared!r}).getOrCreate()\n"
            "print('DIR', ensure_checkpoint_dir(s))\n"
            "print('SCRATCH', scratch_path(s, 'x'))\n"
            "print('SC', s.sparkContext.getCheckpointDir())\n")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300).stdout
    assert f"DIR {shared}" in out and f"SCRATCH {shared}/x" in out
    sc_dir = [l for l in out.splitlines() if l.startswith("SC ")][0]
    assert shared in sc_dir


def test_unset_checkpoint_dir_is_refused_off_local():
    """A cluster master without a shared folder is an error (no session is started)."""
    from types import SimpleNamespace

    import pytest

    from tabula.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: default)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,512]"):
        sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master=master)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_unset_checkpoint_dir_gets_scratch(spark):
    from tabula.session import ensure_checkpoint_dir

    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == d  # stable within a session
