"""Sales sources: raw CSV (bronze), catalog tables, fallback and tolerant loads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SALES_RAW_SCHEMA

LINEAGE_TIME = "_ingestion_time"
LINEAGE_FILE = "_source_file"


# Texts read as missing values by the single-file script.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_sales_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Scan raw order-line CSV files as they are: header row, all strings.

    Every column of the header is read as a string (no inference pass over the
    data). With ``schema``, its columns are then picked by header name, so the
    column order of the file does not matter and extra columns are allowed; a
    missing column is an error.
    """
    df = (
        spark.read.option("header", "true")
        .option("inferSchema", "false")
        .option("encoding", encoding)
        .csv(path)
    )
    if schema is None:
        return df
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"sales file lacks columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def with_lineage(df: DataFrame, source_file: Column | None = None) -> DataFrame:
    """Add the two audit columns of the bronze layer.

    ``_source_file`` comes from the hidden ``_metadata.file_path`` column of
    file sources unless a column is passed in (sources that are not files).
    """
    file_col = source_file if source_file is not None else F.col("_metadata.file_path")
    return df.withColumns({LINEAGE_TIME: F.current_timestamp(), LINEAGE_FILE: file_col})


def bronze_sales(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """``sales_raw``: the raw file unchanged plus lineage; nothing is dropped."""
    df = read_sales_csv(spark, path)
    df = with_lineage(df)
    if schema is not None:
        missing = [f.name for f in schema.fields if f.name not in df.columns]
        if missing:
            raise ValueError(f"sales file lacks columns {missing}")
        df = df.select(*[f.name for f in schema.fields], LINEAGE_TIME, LINEAGE_FILE)
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def tolerant_sales(
    raw: DataFrame,
    numeric: Iterable[str] = ("sales", "quantity", "discount", "profit", "margem_lucro"),
    required: Iterable[str] = ("order_id", "customer_name", "order_date", "sales"),
    date_column: str = "order_date",
) -> DataFrame:
    """Single-file load path of the standalone model script.

    Texts that the script's reader takes for missing values (``NULL_TOKENS``)
    become NULL in every column, numbers that do not parse or are not a number
    become NULL too (no stripping, no decimal-comma repair, no de-duplication,
    no sign rules), then rows missing any required field are dropped and the
    order date becomes a DATE.
    """
    numeric = list(numeric)
    texts = [c for c, t in raw.dtypes if t == "string"]
    known = raw.withColumns({c: F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)) for c in texts})
    nothing = F.lit(None).cast("double")
    typed = known.withColumns({c: F.nanvl(F.col(c).try_cast("double"), nothing) for c in numeric})
    required = list(required)
    kept = typed.dropna(subset=required) if required else typed
    return kept.withColumn(date_column, F.to_date(F.col(date_column)))


def sales_from_silver(
    spark: SparkSession,
    silver: str = "silver",
    csv_path: str | None = None,
) -> DataFrame:
    """Propensity input: the silver fact enriched with three dimensions.

    Falls back to the raw CSV (explicit all-string schema, tolerant typing)
    when the silver tables do not exist.
    """
    names = [f"{silver}.{t}" for t in ("ft_vendas", "dim_cliente", "dim_localizacao", "dim_produto")]
    if all(spark.catalog.tableExists(n) for n in names):
        from ..operators.enrich import enrich_sales

        ft, cli, loc, prod = (spark.read.table(n) for n in names)
        return enrich_sales(ft, cli, loc, prod)
    if csv_path is None:
        raise FileNotFoundError(f"silver tables {names} not found and no CSV path given")
    raw = read_sales_csv(spark, csv_path, SALES_RAW_SCHEMA)
    return tolerant_sales(raw, required=())
