"""Helpers that the training-data operators share: word rule, scratch tables, table access."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.cluster import shared_dir, ship

#: Words are maximal runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
GAP_PATTERN = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Scratch:
    """Tables written once to the shared folder, so that a lost executor costs no recomputation of earlier steps.

    ``save`` writes a DataFrame as Parquet and returns it reread (lineage ends at the files); ``drop`` removes
    a table when the step that needed it has been written in turn.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        ship(spark)
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """The shuffle files of the job go with its end: what it wrote is all that later steps read."""
        with settings(self.spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def settings(spark: SparkSession, **values: object):
    """Session settings for the jobs run inside (underscores stand for dots), put back afterwards."""
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``docs`` has."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(name: str) -> F.Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(docs: DataFrame, *names: str) -> list[str]:
    """The columns of ``docs`` but those that an operator puts out itself, in any case."""
    own = {n.lower() for n in names}
    return [c for c in docs.columns if c.lower() not in own]


def words_of(text) -> F.Column:
    """Array of the words of a text column; null and blank texts give an empty array."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP_PATTERN))


def n_words_of(text) -> F.Column:
    """Number of words of a text column (null: 0) without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


#: Row tables of up to so many ids are broadcast (16 MB of longs); larger ones meet by a shuffle.
BROADCAST_IDS = 1_000_000


def small(saved: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """A saved narrow table, marked for broadcast if it has at most ``limit`` rows."""
    return F.broadcast(saved) if saved.count() <= limit else saved
