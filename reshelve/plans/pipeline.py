"""The remodelling run: extract, stage, transform, load documents, load the wide table."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from reshelve.config import BATCH_SIZE, PipelineConfig, SourceConfig
from reshelve.operators.document import nest_tables, rows_within
from reshelve.operators.prepare import enrich
from reshelve.operators.wide import to_wide
from reshelve.session import build_session, configure
from reshelve.sinks.collection import FORMAT, load_collection
from reshelve.sinks.documents import LoadCounts, write_documents
from reshelve.sinks.staged import stage
from reshelve.sinks.wide import write_wide
from reshelve.sources.tables import read_staged, read_tables, stored_bytes

STAGES = ("extract", "stage", "transform", "documents", "wide")


class StageError(RuntimeError):
    """A stage was asked for without the one it depends on."""


def choose_stages(only=None, skip=None) -> set[str]:
    """The stages to run; ``only`` wins over ``skip``, and neither means all."""
    if only:
        return set(only)
    return set(STAGES) - set(skip or ())


def check_stages(stages: set[str]) -> None:
    unknown = stages - set(STAGES)
    if unknown:
        raise StageError(f"unknown stages: {', '.join(sorted(unknown))}")
    if "extract" not in stages:
        raise StageError("every run starts with the extract stage")
    if stages & {"documents", "wide"} and "transform" not in stages:
        raise StageError("loading needs the transform stage")


def run(spark: SparkSession, config: PipelineConfig, stages: set[str]) -> LoadCounts | None:
    """Run the stages in their fixed order. Without the stage step the transform reads what
    an earlier run staged. Returns the document counts if documents were loaded."""
    check_stages(stages)
    size = config.input_bytes
    if size is None and not config.source.use_jdbc and config.source.parquet_path:
        size = stored_bytes(spark, config.source.parquet_path)
    configure(spark, size)
    tables = read_tables(spark, config.source)
    if "stage" in stages:
        stage(tables, config.staging_path)
    if "transform" not in stages:
        return None
    if config.input_bytes is None and config.source.use_jdbc:
        configure(spark, stored_bytes(spark, config.staging_path))
    staged = read_staged(spark, config.staging_path)
    counts = None
    if "documents" in stages:
        docs = nest_tables(staged, max_rows=rows_within(config.document_limit))
        if config.document_format == FORMAT:
            counts = load_collection(
                docs, config.documents_path, config.document_limit,
                config.batch_size or BATCH_SIZE, options=dict(config.document_connector or {}))
        else:
            counts = write_documents(
                docs, config.documents_path, config.document_format, config.document_limit,
                config.batch_size, config.document_connector)
    if "wide" in stages:
        write_wide(to_wide(enrich(staged)), config.wide_path, config.wide_format, config.truncate_wide,
                   config.wide_buckets, config.partitions, config.wide_connector)
    return counts


def _option(text: str) -> tuple[str, str]:
    key, separator, value = text.partition("=")
    if not separator:
        raise argparse.ArgumentTypeError(f"{text} is not KEY=VALUE")
    return key, value


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(description="Remodel order tables as documents and wide rows.")
    choice = parser.add_mutually_exclusive_group()
    choice.add_argument("--stages", nargs="+", choices=STAGES, help="run only these")
    choice.add_argument("--skip", nargs="+", choices=STAGES, help="run all but these")
    parser.add_argument("--staging", default="data/staging")
    parser.add_argument("--documents", default="data/documents")
    parser.add_argument("--wide", default="data/wide")
    parser.add_argument("--batch-size", type=int, nargs="?", const=BATCH_SIZE,
                        help=f"documents per file ({BATCH_SIZE} if no number is given)")
    parser.add_argument("--input-bytes", type=int,
                        help="size of the sources, to size shuffles (measured if not given)")
    parser.add_argument("--document-format", default=PipelineConfig.document_format,
                        help=f"a file format, or {FORMAT} to load batch by batch")
    parser.add_argument("--document-limit", type=int, default=PipelineConfig.document_limit)
    parser.add_argument("--document-option", action="append", type=_option, metavar="KEY=VALUE",
                        help="an option of the document store's connector")
    parser.add_argument("--wide-format", default=PipelineConfig.wide_format)
    parser.add_argument("--wide-option", action="append", type=_option, metavar="KEY=VALUE",
                        help="an option of the wide store's connector")
    parser.add_argument("--wide-buckets", type=int)
    parser.add_argument("--append", action="store_true", help="add to the wide table")
    parser.add_argument("--keys-per-stride", type=int, default=SourceConfig.keys_per_stride)
    args = parser.parse_args(argv)
    stages = choose_stages(args.stages, args.skip)
    source = replace(SourceConfig.from_env(), keys_per_stride=args.keys_per_stride)
    config = PipelineConfig(
        source, args.staging, args.documents, args.wide, document_format=args.document_format,
        wide_format=args.wide_format, truncate_wide=not args.append,
        document_connector=dict(args.document_option) if args.document_option else None,
        wide_connector=dict(args.wide_option) if args.wide_option else None,
        wide_buckets=args.wide_buckets, document_limit=args.document_limit,
        batch_size=args.batch_size, input_bytes=args.input_bytes)
    try:
        check_stages(stages)
    except StageError as refused:
        print(refused, file=sys.stderr)
        return 1
    spark = build_session()
    try:
        counts = run(spark, config, stages)
    finally:
        spark.stop()
    if counts is not None:
        print(f"documents: {counts.inserted} of {counts.attempted} inserted, "
              f"{counts.rejected} rejected")
    return 0


if __name__ == "__main__":
    sys.exit(main())
