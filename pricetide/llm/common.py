"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, so far unused folder under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts the lineage
    and fixes the rows, so that a lost executor never makes them anew."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def crc32_mod(id_col: str | Column, k: int) -> Column:
    """crc32 of the id written as text, modulo ``k`` (a null id counts as empty text)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(k))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package's Python files to the executors (once per application), so that
    tasks can import it wherever the driver was started from.  Batches are made of fewer
    rows than Spark's default, as texts are long."""
    import os
    import tempfile
    import zipfile

    import pricetide
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    root = os.path.dirname(os.path.abspath(pricetide.__file__))
    zip_path = os.path.join(tempfile.mkdtemp(prefix="pricetide-ship-"), "pricetide_package.zip")
    with zipfile.ZipFile(zip_path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("pricetide", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(zip_path)       # the driver serves it; executors need no shared folder
    _shipped.add(app)
