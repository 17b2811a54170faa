"""Small DataFrame helpers the operators share."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.session import materialize, ship_code

NO_ID = -(1 << 63)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id`` (null as the smallest long), ``_h`` (hash of the text), ``doc_id`` and ``text``.

    ``(_id, _h)`` tells rows apart; rows that agree in both id and text are one document to the
    operators and get equal results. Columns of other names are left out, so none can clash.
    """
    ship_code(docs.sparkSession)
    ident = F.col(f"`{id_col}`").cast("long")
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(
        F.coalesce(ident, F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_h"),
        ident.alias("doc_id"), text.alias("text"))


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a flat schema text like ``"a long, b array<int>"``."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
             "array<string>": pa.list_(pa.string())}
    fields = (part.strip().split(" ", 1) for part in ddl.split(","))
    return pa.schema([(name, kinds[kind.strip()]) for name, kind in fields])


def list_array(values, starts, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and ``rows + 1`` borders."""
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind))


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def fresh(names, *wanted: str) -> list[str]:
    """The wanted column names, lengthened where ``names`` already has them."""
    taken = {n.lower() for n in names}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


__all__ = ["NO_ID", "arrow_schema", "fresh", "keyed_texts", "list_array", "materialize", "quoted", "sha256",
           "ship_code", "table"]
