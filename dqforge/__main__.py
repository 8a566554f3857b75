"""Command line: run rule configs, suites and checkpoint files against a table.

    python -m dqforge checks     --table PATH_OR_NAME --config rules.json   [--by COL ...]
    python -m dqforge validate   --table PATH_OR_NAME --suite suite.json    [--by COL ...]
    python -m dqforge checkpoint --config chk.yml --suites DIR --asset NAME=PATH ... [--batch-key COL]
    python -m dqforge checksums  --path DIR [--glob '*.csv']

Results are printed as JSON lines; the exit code is 1 when a check failed (``--warn`` keeps 0).
A ``--store PATH`` appends the verdicts to a results store.  The session comes from the
environment (``spark-submit`` / platform defaults); nothing here sets a master.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _frame(spark: SparkSession, src: str, fmt: str):
    if "/" in src or ":" in src:
        return spark.read.format(fmt).load(src)
    return spark.table(src)


def _emit(results, store: str | None, warn: bool) -> int:
    from .sources.tables import store_results

    if store:
        store_results(results, store)
    failed = 0
    for r in results.toLocalIterator():  # verdict rows (one per check per batch), streamed
        d = r.asDict()
        failed += not d.get("passed", True)
        print(json.dumps(d, default=str))
    return 0 if warn or failed == 0 else 1


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="dqforge")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("checks", "validate"):
        s = sub.add_parser(name)
        s.add_argument("--table", required=True)
        s.add_argument("--format", default="parquet")
        s.add_argument("--by", nargs="*", default=[])
        s.add_argument("--store")
        s.add_argument("--warn", action="store_true")
        if name == "checks":
            s.add_argument("--config", required=True, help='JSON: {"column": {...}, "table": {...}}')
        else:
            s.add_argument("--suite", required=True)
    c = sub.add_parser("checkpoint")
    c.add_argument("--config", required=True)
    c.add_argument("--suites", required=True)
    c.add_argument("--asset", nargs="+", required=True, help="NAME=PATH_OR_TABLE")
    c.add_argument("--format", default="parquet")
    c.add_argument("--batch-key")
    c.add_argument("--store")
    c.add_argument("--warn", action="store_true")
    k = sub.add_parser("checksums")
    k.add_argument("--path", required=True)
    k.add_argument("--glob")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"dqforge-{a.cmd}").getOrCreate()
    from .operators import checks as C
    from .operators import expectations as E
    from .operators import integrity as I
    from .session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    if a.cmd == "checks":
        with open(a.config) as f:
            cfg = json.load(f)
        res = C.run_checks(_frame(spark, a.table, a.format), column=cfg.get("column"), table=cfg.get("table"),
                           suite=cfg.get("suite"), by=a.by)
        return _emit(res, a.store, a.warn)
    if a.cmd == "validate":
        return _emit(E.validate(_frame(spark, a.table, a.format), a.suite, by=a.by), a.store, a.warn)
    if a.cmd == "checkpoint":
        assets = {}
        for item in a.asset:
            name, _, src = item.partition("=")
            assets[name] = _frame(spark, src, a.format)
        res = E.run_checkpoint_config(a.config, assets, a.suites, batch_key=a.batch_key)
        return _emit(res, a.store, a.warn)
    for r in I.file_checksums(spark, a.path, glob=a.glob).select("file_name", "length", "md5").toLocalIterator():
        print(json.dumps(r.asDict()))
    return 0


if __name__ == "__main__":
    sys.exit(main())
