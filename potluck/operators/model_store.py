"""Fitted models as tables in the shared folder, found again by what they were
fitted on.

A model's place is named by a fingerprint of its input rows (order-free: count,
sum and xor of row hashes) and of its parameters, so the same fit is made once
and read back after that, also by another job that names the same folder.
Tables are written under a version of their own; a row in ``done``, written
last, makes them visible.  A fit that was broken off is never read, and of two
fits made at once the one with the smaller version is read by all.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from potluck.session import checkpoint_dir


def fingerprint(df: DataFrame, params: Mapping[str, object]) -> str:
    """Hex digest of the rows of ``df`` in any order, its schema and ``params``."""
    rows = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")),
                  F.bit_xor(F.xxhash64(F.lit(1), *df.columns))).first()
    text = json.dumps([df.schema.simpleString(), [str(x) for x in rows], dict(params)], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()


def _finished(spark: SparkSession, place: str) -> str | None:
    try:
        return spark.read.schema("version string").parquet(f"{place}/done").agg(F.min("version")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def fitted(df: DataFrame, name: str, params: Mapping[str, object],
           fit: Callable[[], Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """The tables that ``fit()`` returns, read from the store; ``fit`` runs only
    if no finished model of these rows and parameters is there."""
    spark = df.sparkSession
    place = f"{checkpoint_dir(spark).rstrip('/')}/potluck-models/{name}-{fingerprint(df, params)}"
    version = _finished(spark, place)
    if version is None:
        mine = uuid.uuid4().hex
        tables = fit()
        for key, t in tables.items():
            t.write.parquet(f"{place}/{mine}/{key}")
        names = spark.createDataFrame([(key,) for key in tables], "name string")
        names.coalesce(1).write.parquet(f"{place}/{mine}/tables")
        spark.createDataFrame([(mine,)], "version string").coalesce(1).write.mode("append").parquet(f"{place}/done")
        version = _finished(spark, place)
    listed = spark.read.parquet(f"{place}/{version}/tables").collect()  # a row a table
    return {r["name"]: spark.read.parquet(f"{place}/{version}/{r['name']}") for r in listed}
