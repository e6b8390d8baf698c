"""``python -m tarnlog [--check | --ddl] [FILE]``: run, check or print the DDL of a configuration."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path


def load(path: str) -> dict:
    """A JSON file, or a YAML file where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        return json.loads(text)
    return yaml.safe_load(text)


def main(argv: list[str] | None = None) -> int:
    from tarnlog import config

    cli = argparse.ArgumentParser(prog="tarnlog")
    cli.add_argument("file", nargs="?", default="tarnlog.json")
    cli.add_argument("--check", action="store_true", help="only check the configuration")
    cli.add_argument("--ddl", action="store_true", help="print the table's DDL")
    cli.add_argument("--checkpoint", default="checkpoint")
    args = cli.parse_args(argv)
    try:
        given = load(args.file)
        config.parse(given)
    except (OSError, ValueError) as e:
        print(f"{args.file}: {e}", file=sys.stderr)
        return 1
    if args.check:
        print("configuration is valid")
        return 0
    from tarnlog.streaming import runner

    if args.ddl:
        print(";\n\n".join(runner.ddl_of(given)) + ";")
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("tarnlog").getOrCreate()
    runner.run_until_signal(runner.start(spark, given, args.checkpoint))
    return 0


if __name__ == "__main__":
    sys.exit(main())
