"""Readers: CSV folders, CSV and JSON request payloads, prediction inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from umpire.functions.scoring import name_fields, to_numeric


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The ``*.csv`` files of a folder, by name."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/*.csv")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(f.getPath().toString() for f in found or [])


def read_csv_dir(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 header: bool = True) -> DataFrame:
    """Every ``*.csv`` in a folder as one DataFrame; an empty folder is an error.

    With no schema the header gives the names and all values are strings.
    """
    if not csv_files(spark, path):
        raise ValueError(f"no CSV file in {path}")
    reader = spark.read.option("header", header).option("ignoreLeadingWhiteSpace", True)
    if schema is not None:
        return reader.schema(schema).csv(path.rstrip("/") + "/*.csv")
    return reader.csv(path.rstrip("/") + "/*.csv")


def parse_csv_lines(df: DataFrame, col: str, names: list[str], label: str | None = None,
                    keep: list[str] | tuple = (), mode: str = "coerce", reject: str | None = None) -> DataFrame:
    """Headerless CSV request lines -> named numeric columns.

    A line that has neither as many fields as ``names`` nor one more is not a request:
    its fields are null and ``reject`` names the column that marks it."""
    if mode == "coerce":
        return name_fields(df, col, names, label=label, keep=keep, reject=reject, numeric=True)
    return to_numeric(name_fields(df, col, names, label=label, keep=keep, reject=reject), names, mode=mode, reject=reject)


def parse_json_records(df: DataFrame, col: str, schema: T.StructType, mode: str = "coerce",
                       keep: list[str] | tuple = (), sep: str = ".",
                       label: str | None = None, truth: str = "ground_truth") -> DataFrame:
    """A JSON array of objects per row -> one flat row per object.

    Nested structs are flattened to ``parent<sep>child`` names.  In ``strict``
    mode an unparseable payload raises instead of giving no rows.  With
    ``label`` the truth field, when present, is moved aside to ``truth`` and
    is not a feature (F2).
    """
    arr = F.from_json(F.col(col), T.ArrayType(schema))
    if mode == "strict":
        arr = F.when(arr.isNull() & F.col(col).isNotNull(),
                     F.raise_error(F.concat(F.lit("Malformed JSON payload: "),
                                            F.substring(F.col(col), 1, 80)))
                     .cast(T.ArrayType(schema))).otherwise(arr)
    rows = df.select(*keep, F.explode(arr).alias("_r"))
    flat = rows.select(*keep, *_flatten("_r", schema, "", sep))
    if label:
        flat = flat.withColumnRenamed(label, truth)
    return flat


def _flatten(root: str, schema: T.StructType, prefix: str, sep: str) -> list:
    out = []
    for f in schema.fields:
        path = f"{root}.`{f.name}`"
        name = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += _flatten(path, f.dataType, name + sep, sep)
        else:
            out.append(F.col(path).alias(name))
    return out


def parse_predictions(df: DataFrame, col: str, content_type: str,
                      keep: list[str] | tuple = ()) -> DataFrame:
    """Prediction inputs -> (position, prediction) rows.

    ``application/json`` needs a ``predictions`` key (missing key is an
    error); ``text/csv`` is one number per line.
    """
    if content_type == "application/json":
        body = F.from_json(F.col(col), T.StructType([T.StructField("predictions", T.ArrayType(T.DoubleType()))]))
        arr = F.coalesce(body["predictions"], F.raise_error(F.lit("a JSON prediction input needs the key 'predictions'")).cast(T.ArrayType(T.DoubleType())))
        return df.select(*keep, F.posexplode(arr).alias("position", "prediction"))
    if "text/csv" in content_type:
        lines = F.split(F.col(col), "\n")
        return (df.select(*keep, F.posexplode(lines).alias("position", "_l"))
                .where(F.trim("_l") != "")
                .select(*keep, "position", F.trim("_l").cast("double").alias("prediction")))
    raise ValueError(f"Unsupported content type: {content_type}")
