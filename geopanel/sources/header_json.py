"""JSON arrays of arrays whose first row holds the column names.

``[["RATE","state","county"],["70.1","01","001"], ...]``
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geopanel.session import shared_folder
from geopanel.sources.quoted import quoted_records

_ROWS = "array<array<string>>"
# Values and separators of one inner array: no bracket outside of quotes.
_ONE_ROW = r'^(?:[^"\[\]]++|"(?:[^"\\]++|\\.)*+")*+$'
# An outer array of inner arrays, each closed; brackets in quotes don't count.
_ONE_DOCUMENT = (
    r'^\s*\[\s*(?:\[(?:[^"\[\]]++|"(?:[^"\\]++|\\.)*+")*+\]\s*,?\s*)++\]\s*$'
)


def parse_rows(
    records: DataFrame, fields: Mapping[str, str], value: str = "value",
    header: Sequence[str] | None = None,
) -> DataFrame:
    """One inner array per record, brackets and separators still around it.

    Records are independent, so a large file splits over tasks. The header is the
    record that opens the outer array; all files of one call must agree on it (a
    second distinct header is an error). Naming ``header`` saves the extra pass that
    looks it up. ``fields`` maps output column -> name in the header. A record that is
    not exactly one array of that many values is an error.
    """
    inner = F.regexp_replace(F.col(value), r"^[\s\[]+|[\s\],]+$", "")
    # The parser stops behind the first array, so a record must hold nothing else.
    parsed = F.from_json(F.concat(F.lit("["), inner, F.lit("]")), "array<string>")
    broken = F.raise_error(F.concat(F.lit("not a single row: "), F.col(value)))
    row = F.coalesce(F.when(inner.rlike(_ONE_ROW), parsed), broken.cast("array<string>"))
    opened = F.col(value).rlike(r"^\s*\[\s*\[")
    content = records.filter(inner != "")
    if header is None:
        found = content.filter(opened).select(row.alias("h")).distinct()
        names = found.select(_with_columns(F.col("h"), fields.values())).scalar()
    else:
        names = F.array(*[F.lit(h) for h in header])
    # A row of another length than the header fails in map_from_arrays.
    rows = content.filter(~opened).select(
        F.map_from_arrays(names, row).alias("row")
    )
    return rows.select(
        *[F.element_at("row", F.lit(source)).alias(out) for out, source in fields.items()]
    )


def _with_columns(header: Column, wanted: Iterable[str]) -> Column:
    """The header itself, or an error when a wanted name is not in it."""
    missing = F.array_except(F.array(*[F.lit(w) for w in wanted]), header)
    return F.when(F.size(missing) == 0, header).otherwise(
        F.raise_error(F.concat(F.lit("not in the header: "), F.array_join(missing, ", ")))
    )


def parse_documents(
    documents: DataFrame, fields: Mapping[str, str], value: str = "value"
) -> DataFrame:
    """A whole document per row: many small answers, each with its own header.

    A text that is not one array of arrays with a header is an error.
    """
    found = F.from_json(F.col(value), _ROWS)
    broken = F.raise_error(F.concat(
        F.lit("not an array of arrays: "), F.coalesce(F.substring(value, 1, 100), F.lit("NULL"))))
    whole = F.col(value).rlike(_ONE_DOCUMENT)
    parsed = documents.select(F.when(
        whole & found.isNotNull() & (F.size(found) > 0), found
    ).otherwise(broken.cast(_ROWS)).alias("rows"))
    header = _with_columns(F.element_at("rows", 1), fields.values()).alias("header")
    data = F.slice("rows", 2, F.greatest(F.size("rows") - 1, F.lit(0)))
    rows = parsed.select(header, F.explode(data).alias("row"))
    return rows.select(*[
        F.element_at("row", F.array_position("header", source).cast("int")).alias(out)
        for out, source in fields.items()
    ])


def _header(first: str | None, wanted: Iterable[str]) -> list[str | None]:
    """The names in the record that opens a file; those wanted must be among them."""
    opened = re.fullmatch(r"\s*\[\s*\[(.*?)[\s\],]*", first or "", re.DOTALL)
    if not opened:
        raise ValueError("a file does not hold one whole array of arrays")
    try:
        names = json.loads(f"[{opened[1]}]")
    except ValueError:
        raise ValueError(f"not a single row: {first[:200]}") from None
    missing = [w for w in wanted if w not in names]
    if missing:
        raise ValueError(f"not in the header: {', '.join(missing)}")
    return names


def _landed(records: DataFrame, flags: Mapping[str, Column], opened: Column, inner: Column,
            names: Sequence[str | None], fields: Mapping[str, str]) -> DataFrame:
    """The fields of every record, parsed once and written, with the flags beside them.

    The record that opens a file must be the header, all others have its length.
    """
    header = F.array(*[F.lit(n).cast("string") for n in names])
    # The parser stops behind the first array, so a record must hold nothing else.
    parsed = F.from_json(F.concat(F.lit("["), inner, F.lit("]")), "array<string>")
    row = F.when(inner.rlike(_ONE_ROW), parsed)

    def fail(why: str) -> Column:
        return F.raise_error(F.concat(F.lit(why), F.substring("value", 1, 200))).cast(
            "array<string>")

    checked = (
        F.when(F.trim(inner) == "", None)
        .when(row.isNull(), fail("not a single row: "))
        .when(opened & ~row.eqNullSafe(header), fail("a file with another header: "))
        .when(F.size(row) != len(names), fail("a row of another length than the header: "))
        .otherwise(row)
    )
    rows = records.select(*[c.alias(f"__{n}") for n, c in flags.items()], checked.alias("__row"))
    table = rows.select(
        *[f"__{n}" for n in flags], F.col("__row").isNotNull().alias("__any"),
        *[F.get("__row", F.lit(names.index(name))).alias(out) for out, name in fields.items()])
    path = shared_folder(records.sparkSession, "header-json-rows")
    table.write.parquet(path)
    return records.sparkSession.read.schema(table.schema).parquet(path)


def _whole_or_error(odd: DataFrame) -> None:
    if not odd.isEmpty():
        raise ValueError("a file does not hold one whole array of arrays")


def _same_header(names: Sequence[str | None], header: Sequence[str] | None) -> None:
    if header is not None and list(header) != list(names):
        raise ValueError(f"a file with another header: {names}")


def read_header_json(
    spark: SparkSession, path: str, fields: Mapping[str, str], layout: str = "rows",
    header: Sequence[str] | None = None,
) -> DataFrame:
    """Read such files, with or without line breaks.

    ``layout="rows"`` cuts the text at every ``],``, so files of any size split over tasks; a
    cut inside a quoted value, a missed one (blanks before the comma) and a file that ends
    early are errors. ``layout="free"`` takes white space anywhere and brackets in values and
    splits over tasks all the same: it cuts at every ``]`` outside of quotes, which takes a
    second pass that counts quotes. Both parse every record once, write the fields to the
    shared folder and check there that each file opens and closes its array once; all files
    share a header (``header`` if named), each row has its length.

    ``layout="documents"`` reads files that each have a header of their own, one file per
    row, and takes any valid layout.
    """
    if layout == "documents":
        return parse_documents(spark.read.text(path, wholetext=True), fields)
    if layout == "free":
        return _read_free(spark, path, fields, header)
    if layout != "rows":
        raise ValueError('layout is "rows", "free" or "documents"')
    records = spark.read.text(path, lineSep="],").select(
        "value", F.col("_metadata.file_path").alias("file"))
    # The head of one file; every file's own is compared with it.
    names = _header(getattr(records.first(), "value", None), fields.values())
    _same_header(names, header)
    opened = F.col("value").rlike(r"^\s*\[\s*\[")
    landed = _landed(records, {
        "file": F.col("file"), "opened": opened,
        "closed": F.col("value").rlike(r"\]\s*\]\s*$|^\s*\]\s*$"),
    }, opened, F.regexp_replace("value", r"^[\s\[]+|[\s\],]+$", ""), names, fields)
    ends = landed.groupBy("__file").agg(
        F.count_if("__opened").alias("opened"), F.count_if("__closed").alias("closed"))
    _whole_or_error(ends.filter("opened != 1 OR closed != 1"))
    return landed.filter("__any AND NOT __opened").select(*fields)


def _read_free(
    spark: SparkSession, path: str, fields: Mapping[str, str], header: Sequence[str] | None,
) -> DataFrame:
    """Records are what stands before each ``]`` outside of quotes; the outer one's is blank."""
    records, files = quoted_records(spark, path, "]", escapes=True)
    head = spark.read.text(path, lineSep="]").first()
    names = _header(getattr(head, "value", None), fields.values())
    _same_header(names, header)
    # A header's name with a bracket makes the head shorter than the record; it then differs.
    opened = F.col("value").rlike(r"^\s*\[\s*\[")
    blank = ~F.col("value").rlike(r"\S")
    begun = F.col("value").rlike(r"^\s*(\[|,)\s*\[") | blank
    landed = _landed(records, {
        "file": F.col("file"), "at": F.col("at"), "opened": opened, "blank": blank, "begun": begun,
    }, opened, F.regexp_replace("value", r"^\s*[\[,]?\s*\[\s*|\s+$", ""), names, fields)
    ends = landed.groupBy("__file").agg(
        F.count_if("__opened").alias("opened"), F.count_if("__blank").alias("blank"),
        F.bool_and("__begun").alias("begun"),
        F.max(F.when(~F.col("__blank"), F.col("__at"))).alias("last"),
        F.min(F.when(F.col("__blank"), F.col("__at"))).alias("close"),
        F.min_by("__opened", "__at").alias("first"))
    # White space behind the outer array is a record without an end.
    odd = ends.join(files, ends["__file"] == files["file"]).filter(
        "NOT (opened = 1 AND first AND begun AND blank = 1 + int(open) AND last < close)")
    _whole_or_error(odd)
    return landed.filter("__any AND NOT __opened").select(*fields)
