"""The driver's module without the text operators or a package that they need."""

import subprocess
import sys
from pathlib import Path

import pytest

from playlens.plans import registry

registry.load()
CODE = "import sys\n{}\nimport __spark_entry__ as e\nprint('NAMES', *e.queries()); print('SQL', *e.oracle_sql())"


@pytest.mark.parametrize("hidden", ["ahocorasick", "tiktoken", "playlens.llm"])
def test_other_queries_stay(hidden):
    out = subprocess.run([sys.executable, "-c", CODE.format(f"sys.modules[{hidden!r}] = None")], cwd=Path(__file__).parents[1], capture_output=True, text=True, check=True)
    names, sql = (set(next(x for x in out.stdout.splitlines() if x.startswith(k)).split()[1:]) for k in ("NAMES", "SQL"))
    assert names == set(registry.QUERIES) and sql == set(registry.ORACLES) and hidden in out.stderr
