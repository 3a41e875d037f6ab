"""Command line: ``python -m tierline build|refresh|plan``.

build  --root LANDING --warehouse OUT [--seed CSV] [--corpus-season 2019]
refresh --warehouse OUT
plan   --root LANDING --seasons 2003-04,2019-20 [--grains player,team] [--recapture]
"""

from __future__ import annotations

from tierline.contracts import DEFAULT_ENDPOINT, DEFAULT_SOURCE
import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tierline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="bronze → checks → silver → checks → gold, publish only when green")
    b.add_argument("--root", required=True)
    b.add_argument("--warehouse", required=True)
    b.add_argument("--seed")
    b.add_argument("--corpus-season")
    f = sub.add_parser("refresh", help="follow the changes of bronze into silver and gold")
    f.add_argument("--warehouse", required=True)
    p = sub.add_parser("plan", help="expected partitions split into landed / to_issue")
    p.add_argument("--root", required=True)
    p.add_argument("--seasons", required=True)
    p.add_argument("--grains", default="player,team")
    p.add_argument("--recapture", action="store_true")
    a = ap.parse_args(argv)

    from tierline.session import get_spark

    spark = get_spark()
    if a.cmd == "build":
        from tierline.plans.build import PromotionError, build

        try:
            res = build(spark, a.root, a.warehouse, a.seed, a.corpus_season)
        except PromotionError as e:
            print(json.dumps({"published": False, "layer": e.layer,
                              "failed": {r.name: r.violations for r in e.failed}}))
            return 1
        print(json.dumps({"published": True, "tables": res.tables, "versions": res.versions,
                          "warnings": {r.name: r.violations for rs in res.checks.values() for r in rs
                                       if r.severity == "warn" and r.violations}}))
        return 0
    if a.cmd == "refresh":
        from tierline.plans.refresh import refresh

        rep = refresh(spark, a.warehouse)
        print(json.dumps({"full": rep.full, "changed": rep.changed, "versions": rep.result.versions,
                          "files_read": {t: r.files_read for t, r in rep.files.items()}}))
        return 0
    if a.cmd == "plan":
        from tierline.plans.landing import landed_partitions, plan

        landed = landed_partitions(spark, a.root, DEFAULT_SOURCE, DEFAULT_ENDPOINT)
        for r in plan(spark, landed, a.seasons.split(","), a.grains.split(","), recapture=a.recapture).collect():
            print(json.dumps(r.asDict()))
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
