"""Tables, CSV and JSON files, and the write modes of the jobs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from askloom import schemas


def read_source(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a parquet file or folder by path."""
    if "/" in name or name.endswith(".parquet"):
        return spark.read.parquet(name)
    return spark.table(name)


def read_csv_source(
    spark: SparkSession, path: str, schema: str | T.StructType, *, multi_line: bool = True
) -> DataFrame:
    """CSV with a header; quoted fields may hold line breaks and doubled quotes.

    With ``multi_line`` a file is read by one task. Without it files are split, and no field may
    hold a line break.
    """
    return spark.read.csv(
        path, schema=schema, header=True, multiLine=multi_line, quote='"', escape='"', mode="FAILFAST"
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"',
                                   ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                                   emptyValue="", lineSep="\n")


def rows_to_df(spark: SparkSession, items: dict[str, list[str]], text_col: str) -> DataFrame:
    """``{category: [text, ...]}`` as (category, text) rows, both nullable."""
    rows = [(category, text) for category, texts in items.items() for text in texts]
    return spark.createDataFrame(rows, f"category string, `{text_col}` string")


def explode_items(df: DataFrame, items: str, text_col: str) -> DataFrame:
    """The same for a map column: one row per category and text."""
    return df.select(F.explode(items).alias("category", "_texts")).select(
        "category", F.explode("_texts").alias(text_col)
    )


def questions_to_df(spark: SparkSession, rows: Iterable[dict | None]) -> DataFrame:
    """Generated questions as a table; a missing entry becomes a row with an error."""
    known = schemas.table(schemas.QUESTIONS)
    return spark.createDataFrame(
        [
            (r.get("chunk_id"), r.get("question"), r.get("tries"), r.get("error"))
            if r is not None else (None, None, None, "no question")
            for r in rows
        ],
        known,
    )


def read_demos(spark: SparkSession, path: str) -> DataFrame:
    """The few-shot examples of a saved program (one JSON document per file)."""
    saved = spark.read.json(path, schema=schemas.table(schemas.PROGRAM), multiLine=True)
    return saved.select(F.explode("program.demos").alias("demo")).select("demo.*")


def write_overwrite(df: DataFrame, name: str) -> None:
    """Replace a table, its schema included."""
    df.write.mode("overwrite").saveAsTable(name)


def write_new(df: DataFrame, name: str) -> None:
    """Create a table; an existing one is an error."""
    df.write.mode("errorifexists").saveAsTable(name)


def merged_type(old: T.DataType, new: T.DataType, where: str = "") -> T.DataType:
    """The type that holds both: old fields first, then new ones, at every depth. Types that clash are an error."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        given = {f.name.lower(): f for f in new}
        fields = [
            T.StructField(f.name, merged_type(f.dataType, given[f.name.lower()].dataType, f"{where}.{f.name}"))
            if f.name.lower() in given else T.StructField(f.name, f.dataType)
            for f in old
        ]
        known = {f.name.lower() for f in old}
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new if f.name.lower() not in known])
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged_type(old.elementType, new.elementType, f"{where}[]"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        if old.keyType != new.keyType:
            raise ValueError(f"{where.lstrip('.')}: keys are {new.keyType.simpleString()}, were {old.keyType.simpleString()}")
        return T.MapType(old.keyType, merged_type(old.valueType, new.valueType, f"{where}[]"))
    if isinstance(old, T.NullType) or isinstance(new, T.NullType) or old == new:
        return new if isinstance(old, T.NullType) else old
    raise ValueError(f"{where.lstrip('.')}: {new.simpleString()} does not fit {old.simpleString()}")


def _fitted(value: Column, now: T.DataType, to: T.DataType) -> Column:
    """``value`` rebuilt in a type of :func:`merged_type`; what it lacks is null, and a null stays one."""
    if now.simpleString() == to.simpleString():
        return value
    if isinstance(now, T.StructType) and isinstance(to, T.StructType):
        given = {f.name.lower(): f for f in now}
        fields = [
            (_fitted(value[given[f.name.lower()].name], given[f.name.lower()].dataType, f.dataType)
             if f.name.lower() in given else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in to
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(now, T.ArrayType) and isinstance(to, T.ArrayType):
        return F.transform(value, lambda x: _fitted(x, now.elementType, to.elementType))
    if isinstance(now, T.MapType) and isinstance(to, T.MapType):
        return F.transform_values(value, lambda _, x: _fitted(x, now.valueType, to.valueType))
    return value.cast(to)


def merged_schema(df: DataFrame, old: T.StructType) -> DataFrame:
    """``df`` with the old columns first, and the old fields within them; those it lacks are null."""
    given = {f.name.lower(): f for f in df.schema}
    return df.select(*[
        (_fitted(F.col(f"`{given[f.name.lower()].name}`"), given[f.name.lower()].dataType, f.dataType)
         if f.name.lower() in given else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in merged_type(old, df.schema)
    ])


def write_merged(df: DataFrame, name: str) -> None:
    """Replace the rows of a table but keep the columns and nested fields it has, and add the new ones."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df = merged_schema(df, spark.table(name).schema)
    df.write.mode("overwrite").saveAsTable(name)


def append_metrics(long_metrics: DataFrame, name: str) -> None:
    """Append (run, metric, value) rows to the metric table."""
    long_metrics.write.mode("append").saveAsTable(name)


def write_report(rows: DataFrame, path: str) -> None:
    """The text report as JSON lines."""
    rows.write.mode("overwrite").json(path)


def ensure_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def reset_schema(spark: SparkSession, *names: str, really: bool = False) -> None:
    """Drop the schemas with all their tables and create them empty."""
    if not really:
        raise ValueError("reset_schema drops all tables; pass really=True")
    for name in names:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    for name in dict.fromkeys(names):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def to_driver(df: DataFrame, limit: int):
    """A bounded sample as a pandas frame."""
    return df.limit(limit).toPandas()


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    return df.limit(n)
