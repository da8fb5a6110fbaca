"""Command line: ``python -m arborline run|convert|merge|follow``; every field of Settings is a flag of ``run``."""

from __future__ import annotations

import argparse
import dataclasses
import sys
import types
import typing
from collections.abc import Sequence

from pyspark.sql import SparkSession

from arborline.config import Settings


def _flags(parser: argparse.ArgumentParser) -> None:
    """A flag for each setting, of its type and with its usual value: --min-quality 0.3, --ks 2 3, --no-use-valid-fraction."""
    kinds = typing.get_type_hints(Settings)
    for field in dataclasses.fields(Settings):
        flag, kind = "--" + field.name.replace("_", "-"), kinds[field.name]
        if kind is bool:
            parser.add_argument(flag, action=argparse.BooleanOptionalAction, default=field.default)
        elif typing.get_origin(kind) is tuple:
            parser.add_argument(flag, nargs="*", type=typing.get_args(kind)[0], default=field.default)
        else:
            base = next(k for k in typing.get_args(kind) if k is not type(None)) if isinstance(kind, types.UnionType) else kind
            parser.add_argument(flag, type=base, default=field.default)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="arborline", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="files to tables")
    run.add_argument("--winter", nargs="+", default=[], help="window files, folders or patterns")
    run.add_argument("--legacy", nargs="+", default=[], help="window files that go before the others")
    run.add_argument("--summer", nargs="+", default=[], help="summer index files")
    run.add_argument("--out", required=True)
    _flags(run)
    for name, what in (("convert", "a run's tables to keyed documents"), ("merge", "several folders' documents to one of each name"), ("follow", "as merge, reading files once as they come")):
        one = commands.add_parser(name, help=what)
        one.add_argument("source")
        one.add_argument("out")
        if name == "merge":
            one.add_argument("--whole", action="store_true", help="read all files again, not only changed ones")
    return top


def settings_of(args: argparse.Namespace) -> Settings:
    values = {f.name: getattr(args, f.name) for f in dataclasses.fields(Settings)}
    return Settings(**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    from arborline.plans import run as plans
    from arborline.plans import stream

    args = parser().parse_args(argv)
    if args.command == "run" and not (args.winter or args.legacy):
        print("no winter input", file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.appName("arborline").getOrCreate()
    if args.command == "run":
        print(*plans.run(spark, args.winter, args.summer, args.out, settings_of(args), args.legacy), sep="\n")
    elif args.command == "convert":
        plans.convert(spark, args.source, args.out)
    elif args.command == "merge":
        print(plans.merge(spark, args.source, args.out, incremental=not args.whole).toJSON().first())
    else:
        stream.follow(spark, args.source, args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
