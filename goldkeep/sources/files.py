"""CSV, Parquet and JSON readers and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldkeep.functions.missing import MISSING_TOKENS, normalise_missing


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    tokens: tuple[str, ...] = MISSING_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """A CSV file or folder with headers; missing tokens become null before values are typed.

    Columns of ``schema`` are found by their name in the header, in whatever order they stand
    there; a missing one is an error, and so is a file of a folder whose header differs.
    ``multi_line`` allows line breaks inside quotes but keeps Spark from splitting large files.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    layout = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = spark.read.csv(path, **layout).columns
    absent = [f.name for f in schema.fields if f.name not in header]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}; it has {', '.join(header)}")
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    raw = spark.read.csv(path, schema=text, mode="FAILFAST", enforceSchema=False, **layout)
    names = [f.name for f in schema.fields]
    known = normalise_missing(raw.select(*names), names, tokens)
    return known.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index; a null is an empty field."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet file or folder, optionally only some columns of it."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON documents, one per line."""
    return spark.read.json(path, schema=schema, mode="FAILFAST")


def write_json(df: DataFrame, path: str) -> None:
    """One JSON document per row, null fields written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def documents(df: DataFrame, name: str = "body") -> DataFrame:
    """Each row as one JSON document in a text column."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def parse_documents(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """Add the typed fields of a JSON text column."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return df.withColumn("_doc", F.from_json(column, schema)).select(*df.columns, "_doc.*")


def parse_or_reject(df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
    """Add typed fields of JSON documents of any shape, and ``rejected``: why a document is not
    taken, null for good ones.

    A document is read once as a variant. ``malformed`` is one that is no JSON, ``not an object``
    one without fields, and ``field x`` one whose field x cannot have its type; a field that is
    absent or null is null. A null document is no document and not rejected. Fields of a rejected
    document are null, so nothing of it is taken for data.
    """
    document, parts = F.col("_document"), {n: F.col(f"_field_{i}") for i, n in enumerate(fields)}
    read = df.withColumn("_document", F.try_parse_json(column)).withColumns(
        {
            f"_field_{i}": F.try_variant_get(document, f"$.{name}", kind)
            for i, (name, kind) in enumerate(fields.items())
        }
    )

    def misfit(name: str) -> Column:
        held = F.try_variant_get(document, f"$.{name}", "variant")
        return held.isNotNull() & ~F.is_variant_null(held) & parts[name].isNull()

    why = F.when(F.col(column).isNotNull() & document.isNull(), "malformed")
    why = why.when(~F.schema_of_variant(document).startswith("OBJECT"), "not an object")
    for name in fields:
        why = why.when(misfit(name), f"field {name}")
    read = read.withColumn("_why", why)
    return read.select(
        *df.columns,
        *[F.when(F.col("_why").isNull(), parts[n]).alias(n) for n in fields],
        F.col("_why").alias("rejected"),
    )


def document_shapes(df: DataFrame, column: str) -> DataFrame:
    """``shape``, ``n_documents``: how many documents have which fields of which types; a null
    shape stands for what is no JSON."""
    shape = F.schema_of_variant(F.try_parse_json(column)).alias("shape")
    return df.where(F.col(column).isNotNull()).groupBy(shape).agg(F.count(F.lit(1)).alias("n_documents"))


def common_shape(df: DataFrame, column: str) -> DataFrame:
    """``shape``: one type that all documents which are JSON fit into."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("shape"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """``key``, ``size``, ``ts`` of the stored files under ``path``, keys relative to it.

    Listed with the content pruned away: no file is opened. Empty files and names beginning with
    ``_`` or ``.`` are no objects, as everywhere in Spark.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # the store may name the folder in another form than the caller
    folder = path.rstrip("/").rsplit("/", 1)[-1] + "/"
    key = F.expr(f"substring(path, instr(path, '/{folder}') + {len(folder) + 1})")
    return found.select(key.alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("ts"))
