"""Command line: python -m quartzo.cli --base <lake> <command> ..."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from quartzo.plans import gold, lineage, validate
from quartzo.plans.medallion import SOURCES, Medallion
from quartzo.session import build_session
from quartzo.sources import files
from quartzo.sources import lake as layers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quartzo")
    top.add_argument("--base", required=True, help="folder or URI of the lake")
    top.add_argument("--master", help="Spark master; leave out under spark-submit")
    sub = top.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run one stage, or all")
    run.add_argument("--stage", choices=["bronze", "silver", "gold", "all"], default="all")
    look = sub.add_parser("inspect", help="first rows of a dataset")
    look.add_argument("--layer", choices=layers.LAYERS, required=True)
    look.add_argument("--dataset", required=True)
    look.add_argument("--limit", type=int, default=20)
    sub.add_parser("quality-report")
    ask = sub.add_parser("query")
    ask.add_argument("--name", choices=sorted(gold.NAMED), required=True)
    sub.add_parser("validate")
    trace = sub.add_parser("lineage")
    trace.add_argument("--item-id", type=int, required=True)
    send = sub.add_parser("publish", help="report which files a target lacks")
    send.add_argument("--target", required=True)
    sub.add_parser("check", help="are all landing datasets there?")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session("quartzo", args.master)
    flow = Medallion(spark, args.base, datetime.now(timezone.utc).replace(tzinfo=None))
    if args.command == "check":
        sizes = {n: flow.landing(n).limit(1).count() for n in SOURCES}
        print(json.dumps({"landing": flow.lake.path("landing"), "empty": [n for n, k in sizes.items() if not k], "status": "ok"}))
    elif args.command == "run":
        stages = {"bronze": lambda: print(json.dumps(flow.bronze())), "silver": lambda: print(flow.silver()), "gold": flow.gold}
        if args.stage == "all":
            flow.run()
        else:
            stages[args.stage]()
    elif args.command == "inspect":
        flow.lake.read(args.layer, args.dataset).show(args.limit, truncate=False)
    elif args.command == "quality-report":
        flow.quality_report().show(truncate=False)
        flow.reasons().orderBy("fonte", "motivo").show(100, truncate=False)
    elif args.command == "query":
        gold.named_query(args.name, flow.tables()).show(50, truncate=False)
    elif args.command == "validate":
        results = flow.validate()
        results.show(truncate=False)
        validate.require(results)
    elif args.command == "lineage":
        t = flow.tables()
        lineage.trace(
            args.item_id, layers.read_bronze(flow.lake, "order_items"), flow.lake.read("silver", "order_items"),
            t["fato_vendas"], t["dim_data"], t["dim_produto"],
        ).show(truncate=False)
    elif args.command == "publish":
        for layer in ("bronze", "silver", "quarantine"):
            report = files.publish_report(
                files.manifest(spark, flow.lake.path(layer)), files.manifest(spark, f"{args.target.rstrip('/')}/{layer}")
            )
            print(layer, json.dumps(report.first().asDict()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
