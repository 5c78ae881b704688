"""Command line: ``python -m tierline <job> ...`` or as a ``spark-submit`` target."""

from __future__ import annotations

import argparse
import sys

from tierline.mapping import read_mapping
from tierline.operators.runlog import RunLog
from tierline.plans import dairy, jobs
from tierline.plans.date_dim import DEFAULT_SPAN
from tierline.plans.parameters import INCREMENTAL_LOAD, LOAD_TYPES, RunParameters
from tierline.session import build_session


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tierline")
    parser.add_argument("--base", required=True, help="folder of all layers and of the run log")
    parser.add_argument("--register", action="store_true", help="register tables in the catalog")
    steps = parser.add_subparsers(dest="job", required=True)

    def step(name: str, text: str) -> argparse.ArgumentParser:
        made = steps.add_parser(name, help=text)
        made.add_argument("--run-id", type=int, required=name != "gold", default=0)
        return made

    for made in (step("ingest", "API documents to landing"), step("run", "ingest, bronze and silver")):
        made.add_argument("--dimension-documents", required=True)
        made.add_argument("--fact-documents", required=True)
        made.add_argument("--input-date", required=True)
        made.add_argument("--start-date")
        made.add_argument("--backfill", choices=["0", "1"], default="0")
        _silver_options(made)
        _bronze_options(made)
    _bronze_options(step("bronze", "landing to bronze"))
    silver = step("silver", "bronze to silver")
    _silver_options(silver)
    gold = step("gold", "calendar dimension")
    gold.add_argument("--start", default=DEFAULT_SPAN[0])
    gold.add_argument("--end", default=DEFAULT_SPAN[1])
    gate = step("gate", "succeed only if a step reported success")
    gate.add_argument("--producer", required=True)
    return parser.parse_args(argv)


def _pair(text: str) -> tuple[str, str]:
    table, found, value = text.partition("=")
    if not found:
        raise argparse.ArgumentTypeError(f"{text!r} is not TABLE=VALUE")
    return table, value


def _bronze_options(step: argparse.ArgumentParser) -> None:
    step.add_argument("--multi-line", action="store_true", help="a landed JSON file is one value, not lines")
    step.add_argument("--schema", action="append", type=_pair, default=[], metavar="TABLE=DDL",
                      help="columns of a landed table; saves the pass that infers them")


def _silver_options(step: argparse.ArgumentParser) -> None:
    step.add_argument("--load-type", choices=LOAD_TYPES, default=INCREMENTAL_LOAD)
    step.add_argument("--mapping", help="mapping CSV; the dairy tables without it")
    step.add_argument("--slices", action="append", type=_pair, default=[], metavar="TABLE=EXPRESSION",
                      help="slice number of a silver table's rows, a function of the key")


def _mapping(spark, args: argparse.Namespace):
    return read_mapping(spark, args.mapping) if args.mapping else None


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = build_session(f"tierline-{args.job}")
    base, log = args.base.rstrip("/"), RunLog(spark, f"{args.base.rstrip('/')}/run_log")
    silver_db = dairy.SILVER_DATABASE if args.register else None
    gold_db = dairy.GOLD_DATABASE if args.register else None
    if args.job in ("ingest", "run"):
        parameters = RunParameters(args.run_id, args.input_date, args.start_date or args.input_date,
                                   args.load_type, args.backfill)
        documents = args.dimension_documents, args.fact_documents
        done = (jobs.run_steps(spark, base, parameters, *documents, silver_db, _mapping(spark, args),
                               dict(args.slices), dict(args.schema), args.multi_line)
                if args.job == "run"
                else jobs.ingest(spark, log, parameters, f"{base}/landing", *documents))
    elif args.job == "bronze":
        done = jobs.landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", args.run_id, log,
                                      dict(args.schema), args.multi_line)
    elif args.job == "silver":
        status, _ = jobs.bronze_to_silver(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/dq_failed", args.run_id,
            args.load_type, _mapping(spark, args), log, slices=dict(args.slices), database=silver_db)
        done = status == "success"
    elif args.job == "gold":
        done = jobs.silver_to_gold(spark, f"{base}/gold", args.run_id, log, args.start, args.end, gold_db)
    else:
        done = log.gate(args.run_id, args.producer)
    return 0 if done else 1


if __name__ == "__main__":
    sys.exit(main())
