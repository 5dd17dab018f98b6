"""Run registered queries against their SQL twins: python tests/check_queries.py <sf_dir> [module-or-name ...]"""

from __future__ import annotations

import importlib
import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/", 2)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

from oracle_compare import compare, connect  # noqa: E402

from agorakit.plans import registry  # noqa: E402
from agorakit.session import local_session  # noqa: E402


def main() -> int:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    modules = [w for w in wanted if w in ("batch", "business", "experiments", "quality", "realtime", "sessions")]
    for name in modules:
        importlib.import_module(f"agorakit.plans.{name}")
    if not modules:
        registry.load_all()
    names = [n for n in registry.QUERIES if modules or not wanted or n in wanted]
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            df = registry.QUERIES[name](spark, sf_dir)
            sql = registry.SQL.get(name)
            result = compare(df, con, sql) if sql else f"no sql, {len(df.collect())} rows"
            ok = result is None or (not sql)
        except Exception as error:  # noqa: BLE001
            ok, result = False, "".join(traceback.format_exception_only(error))[:1500]
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {result or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    raise SystemExit(main() > 0)
