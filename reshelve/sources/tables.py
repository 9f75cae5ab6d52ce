"""Read the normalised table set."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from reshelve.config import SourceConfig
from reshelve.schema import JOINED_TABLES, TABLE_KEYS, TABLES

log = logging.getLogger(__name__)

Tables = dict[str, DataFrame]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern finds anything, on any file system Hadoop knows."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(target))


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files below some paths; paths that do not exist count as empty."""
    context, total = spark.sparkContext, 0
    for path in paths:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(context._jsc.hadoopConfiguration())
        if system.exists(target):
            total += system.getContentSummary(target).getLength()
    return total


def read_if_present(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """Read a folder, or give None where there is none."""
    return spark.read.format(fmt).load(path) if path_exists(spark, path) else None


def read_parquet_tables(spark: SparkSession, path: str, names=TABLES) -> Tables:
    """Read ``<path>/<table>.parquet`` for each table that exists."""
    tables = {}
    for name in names:
        df = read_if_present(spark, f"{path}/{name}.parquet")
        if df is None:
            log.warning("table %s not found under %s, skipped", name, path)
        else:
            tables[name] = df
    return tables


def probe_options(config: SourceConfig, table: str) -> dict[str, str]:
    """Options of the one-row query for the key range of a table."""
    key = TABLE_KEYS[table]
    return {
        **config.connection(),
        "query": f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}",
    }


def jdbc_options(config: SourceConfig) -> dict[str, str]:
    """Options of a read."""
    return {**config.connection(), "fetchsize": "5000"}


BINS = 10_000
# Bins that hold more than so many strides are looked into, so many of them at most at a time.
HEAVY, LOOKS = 2, 100


def histogram_options(config: SourceConfig, table: str, low: int, high: int) -> dict[str, str]:
    """Options of the query that counts the rows of a range of keys in BINS bins at most."""
    key, width = TABLE_KEYS[table], bin_width(low, high)
    return {
        **config.connection(),
        "query": f"SELECT FLOOR(({key} - {low}) / {width}.0) AS bin, COUNT(*) AS n FROM {table} "
                 f"WHERE {key} BETWEEN {low} AND {high} "
                 f"GROUP BY FLOOR(({key} - {low}) / {width}.0)",
    }


def bin_width(low: int, high: int) -> int:
    return max(1, -(-(high + 1 - low) // BINS))


def cut_points(ranges: list[tuple[int, int, int]], rows: int) -> list[int]:
    """Keys that part a table so that about that many rows lie between two of them: at the starts
    of ranges of keys (start, width, rows), and inside one with more rows than that in equal
    widths."""
    cuts, held = [], 0
    for start, width, n in sorted(ranges):
        if held and held + n > rows:
            cuts.append(start)
            held = 0
        pieces = max(1, min(width, -(-n // rows)))
        cuts += [start + width * k // pieces for k in range(1, pieces)]
        held = held + n if pieces == 1 else n // pieces
    return cuts


def stride_predicates(key: str, cuts: list[int]) -> list[str]:
    """Conditions that every row of a table meets exactly one of, rows without a key included."""
    if not cuts:
        return ["1 = 1"]
    between = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *between, f"{key} >= {cuts[-1]}"]


def key_range(spark: SparkSession, config: SourceConfig, table: str) -> tuple:
    """Least and greatest key of a table, asked of the database."""
    found = spark.read.format("jdbc").options(**probe_options(config, table)).load().first()
    return tuple(None if value is None else int(value) for value in found)


def key_histogram(spark: SparkSession, config: SourceConfig, table: str, low: int,
                  high: int) -> dict[int, int]:
    """Rows per bin of the key, counted by the database; BINS rows at most."""
    found = spark.read.format("jdbc").options(**histogram_options(config, table, low, high)).load()
    return {int(bin_): int(n) for bin_, n in found.collect()}


def _ranges(spark: SparkSession, config: SourceConfig, table: str, low: int,
            high: int) -> list[tuple[int, int, int]]:
    """Ranges of keys with the rows in each; those that hold very many are parted again, as keys
    between gaps are close together."""
    width = bin_width(low, high)
    bins = key_histogram(spark, config, table, low, high)
    most = HEAVY * config.keys_per_stride
    heavy = sorted((b for b, n in bins.items() if n > most and width > 1),
                   key=lambda b: (-bins[b], b))[:LOOKS]
    found = [(low + b * width, width, n) for b, n in bins.items() if b not in set(heavy)]
    for b in heavy:
        start = low + b * width
        found += _ranges(spark, config, table, start, start + width - 1)
    return found


def strides(spark: SparkSession, config: SourceConfig, table: str) -> list[str]:
    """The conditions by which a table is read: one for a small or empty table; else one per
    ``keys_per_stride`` rows, wherever its keys lie."""
    low, high = key_range(spark, config, table)
    if low is None or high + 1 - low <= config.keys_per_stride:
        return stride_predicates(TABLE_KEYS[table], [])
    cuts = cut_points(_ranges(spark, config, table, low, high), config.keys_per_stride)
    return stride_predicates(TABLE_KEYS[table], cuts)


def read_jdbc_tables(spark: SparkSession, config: SourceConfig, names=TABLES) -> Tables:
    """Read tables in strides of about as many rows each."""
    found = {}
    for name in names:
        options = jdbc_options(config)
        found[name] = spark.read.jdbc(options.pop("url"), name, properties=options,
                                      predicates=strides(spark, config, name))
    return found


def read_tables(spark: SparkSession, config: SourceConfig) -> Tables:
    """Read the table set from the configured source."""
    if config.use_jdbc:
        return read_jdbc_tables(spark, config)
    if not config.parquet_path:
        raise ValueError("a Parquet source needs a folder")
    return read_parquet_tables(spark, config.parquet_path)


def read_staged(spark: SparkSession, path: str, names=JOINED_TABLES) -> Tables:
    """Read the staged tables the remodelling needs; a missing one is an error."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
