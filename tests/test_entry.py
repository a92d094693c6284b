"""The entry module works without the optional parts."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_optional_parts(tmp_path):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/urbanpulse", tmp_path / "urbanpulse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.oracle_sql()); print(len(e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[-1]) >= 52
    # and nothing but the entry module names them
    for folder, _, names in os.walk(tmp_path / "urbanpulse"):
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(folder, n), encoding="utf-8") as f:
                    assert "urbanpulse.llm" not in f.read()
