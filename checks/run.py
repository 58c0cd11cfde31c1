"""Compare queries with their SQL: ``python -m checks.run SF_DIR [NAME ...]``."""

from __future__ import annotations

import sys
import traceback

from cellcast.session import local_session
from checks import compare, registry


def main(sf_dir: str, *names: str) -> int:
    spark = local_session()
    con = compare.connect(sf_dir)
    bad = 0
    for name in names or registry.QUERIES:
        try:
            got = compare.compare(spark, con, registry.QUERIES[name], registry.ORACLES.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            traceback.print_exc(limit=-3)
            got = {"ok": False, "error": str(error)[:1500]}
        bad += not got["ok"]
        shown = got if not got["ok"] else {k: got[k] for k in ("rows", "sec", "checked")}
        print(f"{'ok  ' if got['ok'] else 'FAIL'} {name} {shown}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
