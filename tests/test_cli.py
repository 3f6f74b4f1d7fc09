import os
import subprocess
import sys

from tests import fixtures

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    return subprocess.run(
        [sys.executable, "-m", "lapsewise.cli", "--master", "local[2]", *args],
        capture_output=True, text=True, timeout=600, cwd=ROOT,
    )


def test_cli_pipeline(workdir):
    inputs = fixtures.reference_inputs(workdir)
    r = _run("clean", f"{workdir}/raw", f"{workdir}/cleaned")
    assert r.returncode == 0, r.stderr[-2000:]
    assert '"delimiter": "|"' in r.stdout
    r = _run("load", f"{workdir}/wh", "--clients", inputs["clients"],
             "--products", f"{workdir}/cleaned/layout_4", "--lapses", inputs["lapses"])
    assert r.returncode == 0, r.stderr[-2000:]
    r = _run("marts", f"{workdir}/wh", f"{workdir}/marts")
    assert r.returncode == 0, r.stderr[-2000:]
    r = _run("test", f"{workdir}/wh")
    assert r.returncode == 0, r.stdout + r.stderr[-2000:]
    assert r.stdout.count("PASS") == 20
