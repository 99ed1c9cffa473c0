"""python tests/run_oracles.py [sf dir] [name prefix ...]: all oracle checks with timings."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from playlens.plans import registry  # noqa: E402
from playlens.session import build_session  # noqa: E402
from tests.compare import compare, connect  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    registry.load()
    spark, con = build_session(), connect(sf_dir)
    bad = 0
    for name, build in registry.QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            if name in registry.ORACLES:
                problem, n = compare(spark, con, build, registry.ORACLES[name], sf_dir)
            else:
                problem, n = None, len(build(spark, sf_dir).collect())
        except Exception as e:
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name:36s} rows={n:<7d} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} problems")


if __name__ == "__main__":
    main()
