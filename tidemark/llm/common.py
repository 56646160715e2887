"""What several operators share: words, document keys, tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

#: Characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def row_key(doc_id: Column, text: Column) -> Column:
    """Hex digits that order rows as if shuffled, the same in every run."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))


def hex_fraction(key: Column) -> Column:
    """The first 32 bits of a hex key as a number from 0 to below 1, in the key's order."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the folder all executors share, and read again.

    Cuts the lineage: a lost executor costs no more than the step that ran.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.settled_path = path
    return stored


def forget(*steps: DataFrame) -> None:
    """Removes the folders of settled steps that nothing is read from any more: all that was made of them is settled itself."""
    for step in steps:
        path = step.sparkSession._jvm.org.apache.hadoop.fs.Path(step.settled_path)
        path.getFileSystem(step.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ranked(df: DataFrame, keys: list[str], name: str, purpose: str) -> DataFrame:
    """Adds a number that grows with `keys`, by a distributed sort; stored, as sorting again could number anew."""
    return settled(df.orderBy(*keys).withColumn(name, F.monotonically_increasing_id()), purpose)
