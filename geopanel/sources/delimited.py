"""CSV and TSV files read by column name, and the CSV sink."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geopanel.sources.quoted import quoted_records
from geopanel.sources.schemas import Contract


def read_delimited(
    spark: SparkSession, path: str, contract: Contract, sep: str = ",", trim: bool = False,
    encoding: str = "UTF-8", quoted_newlines: bool = False, malformed: str = "error",
) -> DataFrame:
    """Read the contract's columns from a delimited file with a header.

    Columns are found by header name, so files may carry more columns in any order;
    types come from the contract and are never inferred. Empty fields, ``NA`` and
    ``NaN`` are NULL, ``Inf`` is infinity. Only one header line is read up front; a file of
    the same folder with another header, in another order for instance, is an error.
    So is a field that is not of its type and a row that is too short or too long, unless
    ``malformed="null"`` is said, which makes such fields NULL. ``quoted_newlines`` accepts
    line breaks inside quotes, at the price of a pass that counts quotes; files still split
    over tasks if they are UTF-8, in other encodings a file is one task.
    """
    if malformed not in ("error", "null"):
        raise ValueError('malformed is "error" or "null"')
    options = {
        "header": True, "sep": sep, "encoding": encoding, "nullValue": "NA",
        "positiveInf": "Inf", "negativeInf": "-Inf", "multiLine": quoted_newlines,
        "ignoreLeadingWhiteSpace": trim, "ignoreTrailingWhiteSpace": trim, "escape": '"',
    }
    header = spark.read.options(**options).csv(path).columns
    names = [h.strip() for h in header]
    missing = [c for c in contract if c not in names]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    # The names as they stand in the file: every file's header is compared with them.
    schema = T.StructType([
        T.StructField(h, T._parse_datatype_string(contract.get(n, "string")))
        for h, n in zip(header, names, strict=True)
    ])
    mode = "FAILFAST" if malformed == "error" else "PERMISSIVE"
    if quoted_newlines and encoding.upper() in ("UTF-8", "UTF8"):
        raw = _quoted_rows(spark, path, schema, options | {"mode": mode}).toDF(*names)
        return raw.select(*[_no_nan(raw, c) for c in contract])
    raw = spark.read.options(
        **options, enforceSchema=False, columnPruning=False,
        mode=mode,
    ).schema(schema).csv(path)
    raw = raw.toDF(*names)
    return raw.select(*[_no_nan(raw, c) for c in contract])


def _quoted_rows(
    spark: SparkSession, path: str, schema: T.StructType, options: dict,
) -> DataFrame:
    """Rows of files whose quoted fields may hold line breaks, one parser call per record.

    The first record of each file must be the header.
    """
    records, _ = quoted_records(spark, path, "\n")
    text = F.regexp_replace("value", r"^\ufeff|\r$", "")
    given = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()
             if k not in ("header", "encoding", "multiLine")}

    def parsed(kinds, more=None):
        ddl = ", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds))
        return F.from_csv(text, ddl, given | (more or {}))

    # Names are compared as they stand, also one that reads like a missing value.
    found = parsed(["string"] * len(schema), {"mode": "PERMISSIVE", "nullValue": "\x00"})
    same = [F.trim(found[f"c{i}"]) == F.lit(f.name.strip()) for i, f in enumerate(schema)]
    agrees = F.coalesce(reduce(Column.__and__, same), F.lit(False))
    other = F.raise_error(F.concat(F.lit("a file with another header: "), text)).cast("boolean")
    first = (F.col("at.block") == 0) & (F.col("at.number") == 0)
    data = F.when(first, F.when(agrees, F.lit(False)).otherwise(other)).otherwise(text != "")
    row = parsed([f.dataType.simpleString() for f in schema])
    return records.filter(data).select(row.alias("row")).select("row.*")


def _no_nan(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.DoubleType):
        return F.when(~F.isnan(name), F.col(name)).alias(name)
    return F.col(name)


def read_csv(spark: SparkSession, path: str, contract: Contract, **options) -> DataFrame:
    return read_delimited(spark, path, contract, **options)


def read_tsv(spark: SparkSession, path: str, contract: Contract, **options) -> DataFrame:
    return read_delimited(spark, path, contract, sep="\t", trim=True, **options)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write with a header; NULL as ``NA``, empty text as an empty field, ``Inf``.

    One part file per partition: nothing is gathered into a single task.
    """
    inf = float("inf")
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = (
                F.when(c == inf, "Inf").when(c == -inf, "-Inf")
                .otherwise(c.cast("string"))
            )
        columns.append(c.alias(field.name))
    (
        df.select(*columns)
        .write.mode(mode)
        .options(header=True, nullValue="NA", emptyValue="", escape='"')
        .csv(path)
    )
