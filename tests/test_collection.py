"""The test modules of both folders can be collected together."""

import importlib
import pathlib
import subprocess
import sys

HERE = pathlib.Path(__file__).parent


def test_helpers_come_from_their_own_module():
    helpers = importlib.import_module("helpers")
    assert pathlib.Path(helpers.__file__).parent == HERE


def test_every_module_is_collected():
    run = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", str(HERE)], capture_output=True, text=True,
                         cwd=HERE.parent)
    assert run.returncode == 0, run.stdout[-2000:]
    for module in HERE.rglob("test_*.py"):
        assert module.name in run.stdout
