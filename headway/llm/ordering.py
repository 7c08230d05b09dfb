"""A number per document, in the order of doc_id, also where ids are repeated or missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import free_name, keep


def with_order(documents: DataFrame, name: str) -> DataFrame:
    """`documents` with the long column `name`, which orders them and tells them apart.

    It is the doc_id itself where ids are unique and not null. Otherwise each distinct pair
    of doc_id and text gets a number of its own: by doc_id, rows without one last, then by
    digests of the text. Rows that repeat both share the number and are one document.
    """
    ids = documents.groupBy("doc_id").count()
    if ids.filter("count > 1 or doc_id is null").isEmpty():
        return documents.withColumn(name, F.col("doc_id"))
    one, two = free_name(documents, "text_one"), free_name(documents, "text_two")
    # a null text and an empty one differ in the first
    marked = documents.withColumn(one, F.xxhash64("text")).withColumn(
        two, F.xxhash64(F.lit(1), F.coalesce("text", F.lit("")))
    )
    known = marked.select(F.col("doc_id").alias("_id"), F.col(one).alias("_one"), F.col(two).alias("_two"))
    # a sort over ranges of the key, so numbers that rise within and between partitions fit
    known = known.distinct().orderBy(F.asc_nulls_last("_id"), "_one", "_two")
    known = keep(known.withColumn(name, F.monotonically_increasing_id()), "numbered")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col(one) == F.col("_one")) & (F.col(two) == F.col("_two"))
    return marked.join(known, same).select(*documents.columns, name)
