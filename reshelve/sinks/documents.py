"""Load customer documents into a collection, setting oversize ones aside."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from reshelve.config import DOCUMENT_LIMIT_BYTES
from reshelve.functions.convert import convert_values
from reshelve.operators.document import MARKS, Documents
from reshelve.operators.wide import BUCKET, buckets_for, cluster_by, with_bucket
from reshelve.sources.layout import write_layout

TOO_LARGE = "document exceeds the size limit"
TOO_MANY_ROWS = "customer has more rows than a document can hold"
SIZE = "document_bytes"
DOCUMENTS_PER_BUCKET = 250_000


@dataclass(frozen=True)
class LoadCounts:
    attempted: int
    inserted: int
    rejected: int


def measured(pieces: DataFrame) -> DataFrame:
    """Add the size of each piece as JSON text, without its marks."""
    fields = [c for c in pieces.columns if c not in MARKS]
    return pieces.withColumn(SIZE, F.octet_length(F.to_json(F.struct(*fields))))


def split_by_size(sized: DataFrame, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Documents within the limit, and the pieces of all others with the reason.

    The size of a document that was cut into pieces is not known, and above any limit it was
    cut for.
    """
    fits = F.col("whole") & (F.col(SIZE) <= max_bytes)
    refused = sized.where(~fits).withColumn(
        "reason", F.when(F.col("whole"), TOO_LARGE).otherwise(TOO_MANY_ROWS))
    return sized.where(fits).drop(SIZE, *MARKS), refused.withColumn(
        SIZE, F.when(F.col("whole"), F.col(SIZE)))


def write_documents(docs: Documents, path: str, fmt: str = "parquet",
                    max_bytes: int = DOCUMENT_LIMIT_BYTES, batch_size: int | None = None,
                    connector: Mapping[str, str] | None = None,
                    buckets: int | None = None) -> LoadCounts:
    """Replace the collection with these documents.

    The pieces are staged once as Parquet with their size, which cuts their lineage, and split
    from there. ``rejected`` lists what was set aside and why, ``rejected_pieces`` keeps it. With
    ``connector`` options the accepted documents go to the store the format names, in batches of
    ``batch_size`` if it is given. Otherwise they go to files: a folder per bucket of customers,
    sorted by customer inside, with at most ``batch_size`` documents per file. Without a number
    of ``buckets`` it follows from the number of documents.
    """
    spark = docs.pieces.sparkSession
    staged = f"{path}/staged"
    measured(convert_values(docs.pieces)).write.mode("overwrite").parquet(staged)
    sized = spark.read.parquet(staged)
    accepted, refused = split_by_size(sized, max_bytes)

    # Counted from what was written, so tasks that ran twice do not count twice.
    attempted, inserted = sized.where("first").agg(
        F.count(F.lit(1)), F.count_if(F.col("whole") & (F.col(SIZE) <= max_bytes))).first()
    if connector is None:
        buckets = buckets or buckets_for(inserted, DOCUMENTS_PER_BUCKET)
        refused = with_bucket(refused, buckets)
        laid_out = cluster_by(with_bucket(accepted, buckets), (BUCKET,), (BUCKET, "customer_id"))
        (laid_out.write.mode("overwrite").format(fmt).partitionBy(BUCKET)
         .option("maxRecordsPerFile", batch_size or 0).save(f"{path}/accepted"))
        write_layout(spark, path, buckets)
    else:
        batch = {} if batch_size is None else {"maxBatchSize": str(batch_size)}
        accepted.write.mode("overwrite").format(fmt).options(**{**batch, **connector}).save()

    refused.drop(SIZE, "reason").write.mode("overwrite").parquet(f"{path}/rejected_pieces")
    (refused.where("first").select("customer_id", SIZE, "reason")
     .write.mode("overwrite").parquet(f"{path}/rejected"))
    return LoadCounts(attempted, inserted, attempted - inserted)
