"""What the operators of this subpackage share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sinks import scratch_root

#: the ASCII whitespace that separates words; ``bytes.split()`` uses the same six characters
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it,
    also when the session was started from another folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one all executors share (spark.checkpoint.dir)."""
    return f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    so nothing is computed twice and lost executors cost no recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sample(df: DataFrame, key: Column, rows: int, total: int) -> DataFrame:
    """The ``rows`` rows of least hash. Of ``total`` rows only those below a
    bound on the hash that four times as many pass are ordered, so the task
    that does it gets a bounded number however many tasks there are."""
    h = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    bound = (1 << 40) * min(1.0, 4 * rows / max(total, 1))
    return df.filter(h < F.lit(int(bound))).orderBy(h, key).limit(rows)


def shielded(docs: DataFrame, *used: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with every column but the used ones renamed, so that none
    clashes with an operator's own, and the new names in order."""
    safe = [c if c in used else f"extra_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*safe), safe
