"""Sources (S1-S6): explicit schemas, no inference, everything lazy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Declared schemas of the three ';' files of the analysed pipeline.
INDEX_READINGS_SCHEMA = "`Datetime` TIMESTAMP_NTZ, `Index Name` STRING, `Index Value` STRING"
WEATHER_READINGS_SCHEMA = (
    "`time` TIMESTAMP_NTZ, `condition` STRING, `Wind in km/h` DOUBLE, `Humidity in %` DOUBLE, "
    "`Precipitation in mm` DOUBLE, `Visibility in km` DOUBLE, `UV index` DOUBLE"
)
DAILY_MERGED_SCHEMA = (
    "`datetime` DATE, total_number_of_articles BIGINT, total_articles_about_covid BIGINT, "
    "total_negative_articles BIGINT, ratio_articles_about_covid DOUBLE, ratio_negative_articles DOUBLE, "
    "`Wind in km/h` DOUBLE, `Precipitation in mm` DOUBLE, `Index Value` DOUBLE"
)
NEWS_SCHEMA = "URL STRING, datetime STRING, heading STRING, text STRING, newssite STRING"
OHLCV_RAW_SCHEMA = "Date STRING, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE, `Adj Close` DOUBLE, Volume BIGINT"

_WEATHER_DOUBLES = (
    "tempmax tempmin temp feelslikemax feelslikemin feelslike dew humidity precip precipprob precipcover"
).split()
_WEATHER_DOUBLES_2 = (
    "snow snowdepth windgust windspeed winddir pressure cloudcover visibility solarradiation solarenergy uvindex severerisk"
).split()
DAILY_WEATHER_RAW_SCHEMA = ", ".join(
    ["`_c0` INT", "datetime DATE", "datetimeEpoch BIGINT"]
    + [f"{c} DOUBLE" for c in _WEATHER_DOUBLES]
    + ["preciptype STRING"]
    + [f"{c} DOUBLE" for c in _WEATHER_DOUBLES_2]
    + [
        "sunrise STRING", "sunriseEpoch BIGINT", "sunset STRING", "sunsetEpoch BIGINT", "moonphase DOUBLE",
        "conditions STRING", "description STRING", "icon STRING", "stations STRING", "source STRING",
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet); column pruning and filters push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a CPU-heavy input (text, HTML) over the cores when it arrives in too few splits.

    A large input already has many more splits than cores and is returned unchanged (no shuffle);
    a small one - e.g. a single-row-group file, which Spark cannot split - is round-robin
    repartitioned to ``2 x defaultParallelism`` so the per-row work runs on every core.
    """
    try:
        target = min_partitions or 2 * df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no RDD API: leave the plan as is
        return df
    return df.repartition(target) if splits < target else df


def text_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A driver table whose rows carry heavy per-row work, pruned to ``columns`` and spread."""
    df = table(spark, sf_dir, name)
    return spread(df.select(*columns) if columns else df)


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = ";", header: bool = True) -> DataFrame:
    """Delimited text with a header row and a declared schema (column names may hold blanks, %, /)."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .csv(path)
    )


def read_dictionary(spark: SparkSession, path: str, keep: Sequence[str], word_col: str = "word") -> DataFrame:
    """Comma CSV, lower-case every column name, project the wanted columns plus the word."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    lowered = raw.toDF(*[c.lower() for c in raw.columns])
    return lowered.select(*[F.col(c) for c in keep], F.col(word_col))


def file_position() -> Column:
    """A row's place in the files it is read from: path, block start, row within the block."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def read_wordlist(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    """S3: one term per line; lines starting with ``comment`` are skipped. ``pos`` is the place in the
    files: file path, block start, and the row within the block."""
    lines = spark.read.text(path).select("value", file_position().alias("pos"))
    return lines.where(~F.col("value").startswith(comment)).select(F.col("value").alias("word"), "pos")


def wordlist_terms(words: DataFrame, limit: int) -> list[str]:
    """The first ``limit`` words as literals for a hash-set membership test (T5). A whole list stays a
    table: ``operators.text.remove_stopwords_table``."""
    return [r.word for r in words.orderBy("pos").limit(limit).select("word").collect()]


def explode_json_records(
    df: DataFrame, json_col: str, element_schema: str | T.DataType, array_field: str | None = None
) -> DataFrame:
    """Parse a JSON reply, one row per element of its array (or the object itself), fields flattened."""
    if array_field is None:
        parsed = df.withColumn("_r", F.from_json(F.col(json_col), element_schema))
        return parsed.select(*[c for c in df.columns if c != json_col], "_r.*")
    wrapper = f"struct<{array_field}: array<{element_schema if isinstance(element_schema, str) else element_schema.simpleString()}>>"
    parsed = df.withColumn("_r", F.from_json(F.col(json_col), wrapper))
    exploded = parsed.select(*[c for c in df.columns if c != json_col], F.explode(f"_r.{array_field}").alias("_e"))
    return exploded.select(*[c for c in df.columns if c != json_col], "_e.*")


def append_records(frames: Sequence[DataFrame]) -> DataFrame:
    """S4 append: union by name, missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_ohlcv(spark: SparkSession, path: str) -> DataFrame:
    """Daily price history with ``M/d/yyyy`` dates."""
    raw = read_delimited(spark, path, OHLCV_RAW_SCHEMA, sep=",")
    return raw.withColumn("Date", F.to_date("Date", "M/d/yyyy"))


def read_daily_weather(spark: SparkSession, path: str) -> DataFrame:
    """37-column daily weather; stringified Python lists become ``array<string>``."""
    raw = (
        spark.read.schema(DAILY_WEATHER_RAW_SCHEMA)
        .option("header", True)
        .option("multiLine", False)
        .option("escape", '"')
        .csv(path)
        .withColumnRenamed("_c0", "row")
    )

    def as_list(c: str):
        return F.from_json(F.translate(F.col(c), "'", '"'), "array<string>")

    return raw.withColumn("preciptype", as_list("preciptype")).withColumn("stations", as_list("stations"))
