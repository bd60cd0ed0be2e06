"""Table readers: one entry point that dispatches on the format, plus clean-up."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.exprs import any_of, name_col, present
from statloom.sources import quoted

# File extensions and the text encodings tried for delimited files.
FORMATS = {
    ".csv": "csv",
    ".tsv": "tsv",
    ".json": "json",
    ".jsonl": "jsonl",
    ".ndjson": "jsonl",
    ".parquet": "parquet",
    ".orc": "orc",
}
ENCODINGS = ["utf-8", "iso-8859-1", "windows-1252"]


def infer_format(path: str) -> str:
    extension = os.path.splitext(path.rstrip("/").lower())[1]
    if extension not in FORMATS:
        raise ValueError(f"unsupported file type: {path}")
    return FORMATS[extension]


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
    encoding: str | None = None,
    drop_index: bool = False,
    clean_names: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Read a file or folder. ``limit`` is off by default: no row cap is needed."""
    fmt = fmt or infer_format(path)
    if fmt in ("csv", "tsv"):
        df = read_delimited(spark, path, "\t" if fmt == "tsv" else ",", schema, encoding)
    elif fmt in ("json", "jsonl"):
        reader = spark.read.schema(schema) if schema else spark.read
        df = reader.json(path, multiLine=fmt == "json")
    elif fmt in ("parquet", "orc"):
        reader = spark.read.schema(schema) if schema else spark.read
        df = reader.format(fmt).load(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")
    if drop_index:
        df = df.drop(df.columns[0])
    if clean_names:
        df = sanitize(df)
    return df.limit(limit) if limit else df


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | str | None = None,
    encoding: str | None = None,
    quote: str = '"',
    multiline: bool | None = None,
) -> DataFrame:
    """Delimited text: short rows are padded with NULL, rows with extra fields skipped.

    A quote inside a quoted field is doubled; line breaks may stand inside quotes. Repeated header
    names are numbered. ``read_with_rejected`` also returns the skipped rows.
    """
    return read_with_rejected(spark, path, sep, schema, encoding, quote, multiline)[0]


def read_with_rejected(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | str | None = None,
    encoding: str | None = None,
    quote: str = '"',
    multiline: bool | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rows with too many fields); the latter have the first surplus field as ``_extra``.

    One pass over the lines finds out what isn't given: whether the bytes are UTF-8 (else Latin-1 is
    taken), and whether a line has an odd number of quotes, that is whether fields hold line breaks. Then
    the quotes of the splits tell where records begin, and files stay splittable (``sources.quoted``).
    Only a folder with a file whose quotes don't come out even is read file by file.
    """
    parts = None
    if encoding is None or multiline is None:
        lines = quoted.lines(spark, path)
        parts = quoted.splits(lines, quote)
        facts = parts.agg(F.max("broken").alias("broken"), F.max("odd").alias("odd"), F.max(F.col("whole") % 2 == 1).alias("uneven")).first()
        encoding = encoding or (ENCODINGS[1] if facts["broken"] else ENCODINGS[0])
        if multiline is None and facts["odd"] and not facts["uneven"]:
            decoded = lines if encoding == ENCODINGS[0] else lines.withColumn("line", F.decode(F.col("line").cast("binary"), encoding))
            return _by_records(quoted.records(decoded, parts, quote), schema, sep, quote)
        multiline = bool(facts["odd"]) if multiline is None else multiline
    options = {"sep": sep, "encoding": encoding, "quote": quote, "escape": quote, "multiLine": multiline}
    if schema is None:
        names = unique_names(_header(spark, path, options))
        kinds = spark.read.csv(path, inferSchema=True, header=True, **options).schema
        schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, kinds.fields)])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    # One more field than the table has: it is filled only by rows that are too long.
    wide = T.StructType([*schema.fields, T.StructField("_extra", T.StringType())])
    df = spark.read.schema(wide).csv(path, mode="PERMISSIVE", header=True, **options)
    return df.filter(F.col("_extra").isNull()).drop("_extra"), df.filter(F.col("_extra").isNotNull())


def _by_records(found: DataFrame, schema: T.StructType | str | None, sep: str, quote: str) -> tuple[DataFrame, DataFrame]:
    """The rows of records; the first of every file is its header."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    rest = found.where("not first")
    if schema is None:
        header = found.where("first").orderBy("file").select("record").first()["record"]
        # as many fields as separators would give; those that the header doesn't have are NULL
        most = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(header.count(sep) + 1)])
        cells = quoted.parsed(found.where("first").orderBy("file").limit(1), most, sep, quote).first()
        names = list(cells)
        while len(names) > 1 and names[-1] is None:
            names.pop()
        names = unique_names(["" if n is None else n for n in names])
        texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
        schema = quoted.inferred(quoted.parsed(rest, texts, sep, quote))
    wide = T.StructType([*schema.fields, T.StructField("_extra", T.StringType())])
    df = quoted.parsed(rest, wide, sep, quote)
    return df.filter(F.col("_extra").isNull()).drop("_extra"), df.filter(F.col("_extra").isNotNull())


def _header(spark: SparkSession, path: str, options: dict) -> list[str]:
    """The header as it is written: the engine's own header names are already changed."""
    first = spark.read.csv(path, header=False, **options).limit(1).collect()
    return ["" if v is None else v for v in first[0]] if first else []


def unique_names(names: list[str]) -> list[str]:
    """Trim names, flatten line breaks, number repeats ``_2``, ``_3``... with numbers that are free."""
    plain = [raw.strip().replace("\n", " ").replace("\r", "") for raw in names]
    taken = set(plain)
    seen: dict[str, int] = {}
    out = []
    for name in plain:
        count = seen.get(name, 0) + 1
        chosen = name
        while count > 1 and (chosen := f"{name}_{count}") in taken:
            count += 1
        seen[name] = count
        taken.add(chosen)
        out.append(chosen)
    return out


def drop_empty(df: DataFrame) -> DataFrame:
    """Remove all-null rows, then all-null columns (one counting job)."""
    cells = [present(df, c) for c in df.columns]
    rows = df.filter(any_of([c.isNotNull() for c in cells]))
    counts = df.agg(*[F.count(c).alias(f"c{i}") for i, c in enumerate(cells)]).first()
    keep = [c for i, c in enumerate(df.columns) if counts[i] > 0]
    return rows.select(*[name_col(c) for c in keep])


def sanitize(df: DataFrame) -> DataFrame:
    """Clean column names, then drop empty rows and empty columns."""
    return drop_empty(df.toDF(*unique_names(df.columns)))


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows under an explicit order (all columns when none is given)."""
    keys = order_by or df.columns
    return df.orderBy(*[name_col(k) for k in keys]).limit(n)
