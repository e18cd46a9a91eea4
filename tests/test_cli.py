"""The command line, in separate processes (as a user runs it)."""
import os
import subprocess
import sys

from emporium.sources.csv_source import write_csv_sources
from emporium.sources.driver_tables import marketplace_sources

from .conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    out = subprocess.run([sys.executable, "-m", "emporium", "--master", "local[2]", *args], cwd=REPO,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_elt_then_query_in_another_process(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    write_csv_sources(dict(marketplace_sources(spark, SF_SMALL)), src)
    wh = os.path.join(tmpdir_path, "wh")
    out = _run("elt", "--source-dir", src, "--warehouse-dir", wh)
    assert "loaded 8 tables into marketplace" in out
    q = _run("query", "--warehouse-dir", wh, "--sql", "SELECT COUNT(*) AS n FROM marketplace.vw_seller_monthly")
    from emporium.registry import QUERIES
    n = QUERIES["v_seller_monthly"](spark, SF_SMALL).count()
    assert f"|{n}|" in q.replace(" ", "")
