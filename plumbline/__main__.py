"""Jobs for spark-submit or ``python -m plumbline``.

    profile INPUT RESULT_FOLDER [--volatility HOURS] [--time-format FORMAT]... [--bindings PATH]...
            [--series START END DAYS] [--format json|text|csv|parquet|...] [--option KEY=VALUE]... [--columns A,B]
            [--before CHARS --after CHARS [--header A,B]] [--digits-only]
    assess CONFIGURATION SAMPLE

Delimited text is ``--format csv`` with ``--option header=true`` or ``--option sep=;``. With ``--series`` the input is a strftime pattern of file names. Text input needs the characters that stand before
and after a cell. The configuration of an assessment is a text of 14 lines, see ``AssessmentSpec.from_lines``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .functions.times import DEFAULT_VOLATILITY_HOURS, dated_names
from .operators.inference import ColumnTypes
from .plans.assess import AssessmentResult, assess
from .plans.profile import profile_files
from .sources.readers import TextLayout
from .sources.state import SourceState
from .spec import AssessmentSpec, ProfileSpec


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="plumbline")
    parser.add_argument("--as-of", help="analysis time, yyyy-mm-dd hh:mm:ss; now by default")
    jobs = parser.add_subparsers(dest="job", required=True)
    profile = jobs.add_parser("profile")
    profile.add_argument("input")
    profile.add_argument("result_folder")
    profile.add_argument("--volatility", type=float, default=DEFAULT_VOLATILITY_HOURS)
    profile.add_argument("--time-format", action="append", default=[])
    profile.add_argument("--bindings", action="append", default=[])
    profile.add_argument("--series", nargs=3, metavar=("START", "END", "DAYS"))
    profile.add_argument("--format", default="json")
    profile.add_argument("--before")
    profile.add_argument("--after")
    names = lambda text: tuple(text.split(","))      # noqa: E731
    profile.add_argument("--header", type=names)
    profile.add_argument("--columns", type=names, help="fields of JSON batches, instead of a pass to find them")
    profile.add_argument("--digits-only", action="store_true", help="numbers are written in digits only")
    profile.add_argument("--option", action="append", default=[], help="of the reader, as key=value")
    assessment = jobs.add_parser("assess")
    assessment.add_argument("configuration")
    assessment.add_argument("sample", type=float)
    return parser


def run_profile(spark: SparkSession, options: argparse.Namespace, as_of: dt.datetime | str) -> bool:
    paths = [options.input]
    if options.series:
        start, end, days = options.series
        paths = dated_names(options.input, start, end, int(days))
        if not paths:
            raise ValueError("the series names no file: check the pattern, the start and the end")
    layout = TextLayout(options.before, options.after, options.header) if options.before and options.after else None
    spec = ProfileSpec(options.result_folder, options.volatility, tuple(options.time_format), tuple(options.bindings),
                       options.format, layout, options.columns, options.digits_only,
                       dict(o.split("=", 1) for o in options.option))
    return profile_files(spark, paths, spec, as_of)


def run_assessment(spark: SparkSession, options: argparse.Namespace, as_of: dt.datetime | str) -> AssessmentResult:
    lines = spark.read.text(options.configuration, wholetext=True).head()["value"].splitlines()
    metadata = SourceState(spark, lines[0].split(";")[0]).metadata()
    types = metadata.types if metadata else ColumnTypes({})
    return assess(spark, AssessmentSpec.from_lines(lines + [""] * (14 - len(lines)), types, options.sample), as_of)


def main(arguments_given: Sequence[str] | None = None) -> int:
    options = arguments().parse_args(arguments_given)
    spark = SparkSession.builder.appName(f"plumbline {options.job}").getOrCreate()
    as_of = options.as_of or dt.datetime.now(dt.timezone.utc)
    if options.job == "profile":
        print("profiled" if run_profile(spark, options, as_of) else "analysed before")
        return 0
    result = run_assessment(spark, options, as_of)
    for name, path in result.tables.items():
        print(f"{name}: {path}")
    for name, error in result.errors.items():
        print(f"{name} failed: {error}", file=sys.stderr)
    return 1 if result.errors else 0


if __name__ == "__main__":
    sys.exit(main())
