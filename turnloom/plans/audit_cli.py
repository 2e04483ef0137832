"""Audits from the command line: ``python -m turnloom.plans.audit_cli run|report|validate TARGET``; 1 if anything was found."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from ..operators import audit
from ..sources.tables import formulas

FORMS = {"md": audit.findings_markdown, "json": audit.findings_json, "console": audit.findings_console}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="audit")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("run", "report", "validate"):
        one = commands.add_parser(name)
        one.add_argument("target", help="a folder of definitions, or one file")
        one.add_argument("--output-dir", "-o")
        one.add_argument("--format", "-f", choices=sorted(FORMS), default="md" if name != "validate" else "console")
    return out


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    path = args.target if args.target.endswith(".toml") else os.path.join(args.target, "*.toml")
    found = audit.audit(formulas(spark, path)).cache()
    text = FORMS[args.format](found)
    if args.output_dir:
        os.makedirs(args.output_dir, exist_ok=True)
        with open(os.path.join(args.output_dir, f"audit.{'txt' if args.format == 'console' else args.format}"), "w", encoding="utf-8") as f:
            f.write(text)
    else:
        print(text)
    some = not found.isEmpty()
    found.unpersist()
    return int(some and args.command != "report")


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
