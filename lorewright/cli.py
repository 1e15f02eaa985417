"""python -m lorewright.cli --config FILE [--steps 01,08] [--list]"""

from __future__ import annotations

import argparse
import sys

from lorewright.plans.pipeline import STEPS, Config, run, success_rate
from lorewright.session import build_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--config")
    p.add_argument("--steps", help="comma-separated numbers, keys or beginnings of keys")
    p.add_argument("--list", action="store_true", help="list the steps and end")
    a = p.parse_args(argv)
    if a.list or not a.config:
        print("\n".join(f"{s.key}\t{s.description}\t{s.output}" for s in STEPS))
        return 0
    outcomes = run(build_session(), Config.load(a.config), a.steps.split(",") if a.steps else None)
    for o in outcomes:
        print(f"{o.key}\t{o.status}\t{o.rows} rows\t{o.size / 1e6:.1f} MB\t{o.seconds:.1f}s\t{o.error}")
    print(f"{success_rate(outcomes):.1f}% of {len(outcomes)} done")
    return int(any(o.status == "failed" for o in outcomes))


if __name__ == "__main__":
    sys.exit(main())
