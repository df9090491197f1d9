"""Command line: ``python -m readloom.plans.cli run --config FILE``, ``run-step`` with a choice of steps."""

from __future__ import annotations

import argparse

from .config import Config
from .steps import run_steps


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="readloom")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "run-step"):
        c = sub.add_parser(name)
        c.add_argument("--config", required=True)
        c.add_argument("--output", default=".")
        c.add_argument("--dry-run", action="store_true")
        if name == "run-step":
            c.add_argument("--from", dest="first")
            c.add_argument("--to", dest="last")
            c.add_argument("--only", nargs="*", default=())
            c.add_argument("--skip", nargs="*", default=())
    return p


def main(argv: list[str] | None = None, runners: dict | None = None) -> list[str]:
    args = parser().parse_args(argv)
    config = Config.read(args.config)
    choice = {k: getattr(args, k) for k in ("first", "last", "only", "skip")} if args.command == "run-step" else {}
    config.select(**choice)
    if runners is None and not args.dry_run:
        from pyspark.sql import SparkSession

        from .runners import runners as own

        runners = own(SparkSession.builder.appName("readloom").getOrCreate())
    said = run_steps(config, runners or {}, config.run_folder(args.output), args.dry_run)
    print("\n".join(said))
    return said


if __name__ == "__main__":
    main()
