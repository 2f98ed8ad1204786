"""Readers. Every one is lazy and splits its input by file or by record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarack.functions.html import unescape_entities

_DIFFERENT = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_WINDOWS_LETTERS = ("".join(map(chr, _DIFFERENT)), bytes(_DIFFERENT).decode("cp1252"))
LOG_SCHEMA = "iter int, accuracy double, loss double"


def read_csv_typed(
    spark: SparkSession, path: str, schema: str | T.StructType, encoding: str = "UTF-8"
) -> DataFrame:
    """Quoted CSV with a header and a fixed schema; empty fields are NULL.

    A quote inside a quoted field is written twice. Spark does not read
    windows-1252, which is ISO-8859-1 with letters in place of some control
    characters; those are put in afterwards.
    """
    windows = encoding.lower() in ("windows-1252", "cp1252")
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    rows = reader.option("encoding", "ISO-8859-1" if windows else encoding).csv(path)
    if not windows:
        return rows
    texts = [f.name for f in rows.schema if isinstance(f.dataType, T.StringType)]
    return rows.withColumns({c: F.translate(c, *_WINDOWS_LETTERS) for c in texts})


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with types found by reading it once more; for exploration."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_csv_audited(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV with one more column ``line``: the raw line of a row that is not well formed, else NULL.

    Lazy; a caller that uses the good and the bad rows apart may want to write it first.
    """
    wide = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*wide.fields, T.StructField("line", T.StringType())])
    return (
        spark.read.schema(wide)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "line")
        .option("columnPruning", False)  # a pruned parse would miss bad fields
        .csv(path)
    )


# How a field of each type is written.
_WRITTEN = {
    "int": r"[+-]?[0-9]{1,9}", "bigint": r"[+-]?[0-9]{1,18}", "smallint": r"[+-]?[0-9]{1,4}", "boolean": "(?i)true|false",
    "double": r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", "float": r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
}


def repair_csv_lines(rows: DataFrame, schema: str, line: str = "line", patterns: dict[str, str] | None = None) -> DataFrame:
    """Lines whose unquoted commas cut a text in two, put together again where that can be done in one way.

    Neighbouring fields are joined until the line has the columns of ``schema`` and every field
    can be of its type. A comma belongs to a text only if a blank follows it; other types are one
    field, and may be empty. ``patterns`` are regular expressions for whole texts of a column. Adds the
    columns of the schema and ``n_fits``, the ways to fit the line: 1, else the columns are NULL;
    2 stands for two or more. All ways are counted column by column, in a state no longer than the line.
    Quotes are not looked at, so lines that have any are not fitted.
    """
    fields, patterns = T._parse_datatype_string(schema).fields, patterns or {}
    texts = [isinstance(f.dataType, T.StringType) for f in fields]
    known = [patterns.get(f.name) or _WRITTEN.get(f.dataType.simpleString(), ".*") for f in fields]
    known = [p if text else rf"\s*({p})?\s*" for p, text in zip(known, texts, strict=True)]
    known = [".*" if text and f.name not in patterns else p for p, text, f in zip(known, texts, fields, strict=True)]
    columns = F.array(
        *[F.struct(F.lit(rf"(?s)^(?:{p})$").alias("pattern"), F.lit(t).alias("text")) for p, t in zip(known, texts, strict=True)]
    )

    def fit(parts: Column) -> Column:
        m = F.size(parts)

        def step(state: Column, column: Column) -> Column:
            def reach(end: Column) -> Column:
                """Ways to fill the columns up to this one with the first ``end`` parts."""

                def from_start(found: Column, start: Column) -> Column:
                    cut = F.slice(parts, start + 1, end - start)
                    more = F.slice(parts, start + 2, end - start - 1)
                    joined = F.when(column["text"], F.forall(more, lambda x: x.startswith(" "))).otherwise(F.size(more) == 0)
                    before = F.get(state, start)
                    ok = (before["ways"] > 0) & joined & F.regexp_like(F.array_join(cut, ","), column["pattern"])
                    both = F.struct(
                        F.least(found["ways"] + before["ways"], F.lit(2)).alias("ways"),
                        F.when(found["ways"] == 0, F.concat(before["ends"], F.array(end))).otherwise(found["ends"]).alias("ends"),
                    )
                    return F.when(ok, both).otherwise(found)

                starts = F.when(end > 0, F.sequence(F.lit(0), end - 1)).otherwise(F.array().cast("array<int>"))
                return F.aggregate(starts, nothing, from_start)

            return F.transform(F.sequence(F.lit(0), m), reach)

        nothing = F.struct(F.lit(0).alias("ways"), F.array().cast("array<int>").alias("ends"))
        begun = F.struct(F.lit(1).alias("ways"), F.array().cast("array<int>").alias("ends"))
        start = F.transform(F.sequence(F.lit(0), m), lambda i: F.when(i == 0, begun).otherwise(nothing))
        last = F.aggregate(columns, start, step)
        return F.get(last, m)

    plain = F.when(~F.col(line).contains('"'), F.split(line, ",", -1))
    cut = rows.withColumn("__parts", plain)
    cut = cut.withColumn("__fit", F.when(F.size("__parts") >= len(fields), F.get(F.transform(F.array("__parts"), fit), 0)))
    ways, ends = F.coalesce(F.col("__fit.ways"), F.lit(0)), F.col("__fit.ends")
    out = {}
    for i, f in enumerate(fields):
        first = F.get(ends, i - 1) if i else F.lit(0)
        value = F.array_join(F.slice(F.col("__parts"), first + 1, F.get(ends, i) - first), ",")
        value = F.nullif(value, F.lit("")) if texts[i] else F.trim(value).try_cast(f.dataType)
        out[f.name] = F.when(ways == 1, value)
    return cut.withColumns(out | {"n_fits": ways}).drop("__parts", "__fit")


def read_delimited(
    spark: SparkSession, path: str, schema: str, delimiter: str = "::"
) -> DataFrame:
    """Lines of fields parted by a (several character) delimiter; bad fields are NULL."""
    fields = T._parse_datatype_string(schema).fields
    parts = F.split("value", _quoted(delimiter))
    return spark.read.text(path).select(
        *[F.get(parts, i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)]
    )


def _quoted(literal: str) -> str:
    return r"\Q" + literal + r"\E"


def read_documents_sgml(
    spark: SparkSession, path: str, record: str = "REUTERS", glob: str = "*.sgm"
) -> DataFrame:
    """``(doc_id, text)`` of tagged records in the matching files.

    The end tag of a record is the line separator, so a large file is read in
    splits and a row is one record. Undecodable bytes are left out; ``text`` is
    all text inside ``<TEXT>``, with its character references replaced.
    """
    raw = (
        spark.read.option("lineSep", f"</{record}>")
        .option("pathGlobFilter", glob)
        .text(path)
        .select(F.regexp_replace("value", "�", "").alias("value"))
    )
    head = rf'(?is)<{record}\b[^>]*\bNEWID="(\d+)"'
    body = F.regexp_extract("value", r"(?is)<TEXT\b[^>]*>(.*?)</TEXT>", 1)
    plain = unescape_entities(F.regexp_replace(body, r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>", ""))
    return raw.filter(F.col("value").rlike(head)).select(
        F.regexp_extract("value", head, 1).cast("bigint").alias("doc_id"), plain.alias("text")
    )


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON array of objects; parallel over files."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_tsv_log(spark: SparkSession, path: str, schema: str = LOG_SCHEMA) -> DataFrame:
    """Tab-separated training log with a header."""
    return spark.read.schema(schema).option("header", True).option("sep", "\t").csv(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")
