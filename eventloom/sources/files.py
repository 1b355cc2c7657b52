"""Reading files with a declared schema, and loading staged files into typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.contract import EVENT_SCHEMA
from eventloom.functions.text import has_content, strip
from eventloom.operators.rows import computed_once
from eventloom.operators.skew import attach_groups, stored_small
from eventloom.session import cut_lineage

CORRUPT = "_corrupt_record"


def read_json_lines(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType = EVENT_SCHEMA, keep_corrupt: bool = False
) -> DataFrame:
    """JSON Lines by schema. A malformed line becomes a row of nulls; ``keep_corrupt`` adds its text."""
    paths = path if isinstance(path, str) else list(path)
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(paths)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in ``value``."""
    return spark.read.text(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    header: bool = True,
    quote: str = '"',
    null_if: Sequence[str] = (),
) -> DataFrame:
    """CSV by schema; every token in ``null_if``, and an empty field, becomes null before the type is applied."""
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in target])
    raw = (
        spark.read.schema(as_text)
        .option("sep", sep).option("header", header).option("quote", quote).option("escape", quote)
        .option("enforceSchema", False).option("emptyValue", "")
        .csv(path)
    )
    tokens = {"", *null_if}
    return raw.select(
        *[F.when(~F.col(f.name).isin(*tokens), F.col(f.name)).try_cast(f.dataType).alias(f.name) for f in target]
    )


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV columns matched to the target by name, file by file, whatever their order and case; unmatched ones are null.

    The first line of each file tells where its columns stand. Lines meet the places of their file in the executors
    and are parsed by them there; only the greatest number of columns comes to the driver. A record is one line; empty
    lines and a folder without lines give no rows.
    """
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size"),
        F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"),
    )
    # The first line of a file is the first row of its first block.
    first = lines.where("_start = 0").groupBy("_file").agg(F.min(F.struct("_at", "value")).alias("_head"), F.max("_size").alias("_size"))
    heads = cut_lineage(first.select("_file", "_size", F.col("_head._at").alias("_head_at"), F.col("_head.value").alias("_head")))
    width = heads.agg(F.max(F.size(F.split("_head", ",")))).first()[0] or 1
    shape = ", ".join(f"_{i} string" for i in range(width))

    def fields(line: str) -> Column:
        parsed = F.from_csv(F.col(line), shape)
        return F.array(*[parsed[f"_{i}"] for i in range(width)])

    names = F.transform(fields("_head"), F.lower)
    places = F.array(*[F.array_position(F.coalesce(names, F.array()), f.name.lower()).cast("int") for f in target])
    placed = attach_groups(lines, heads.select("_file", "_size", "_head_at", places.alias("_places")).withColumnRenamed("_size", "_weight"), ["_file"], "_weight", ["_head_at", "_places"])
    body = placed.where((F.col("_at") != F.col("_head_at")) & has_content(F.col("value")))
    values = computed_once(body.select("value", "_places"), {"_fields": fields("value")})
    return values.select(*[
        F.when(F.col("_places")[i] > 0, F.get("_fields", F.col("_places")[i] - 1)).cast(f.dataType).alias(f.name) for i, f in enumerate(target)
    ])


def average_score(spark: SparkSession, path: str) -> DataFrame:
    """Mean of a file with one number per line; blank lines are skipped, no number at all gives 0."""
    line = strip(F.col("value"))
    numbers = spark.read.text(path).where(has_content(F.col("value"))).select(line.cast("double").alias("score"))
    return numbers.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("average"))


def staged_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of staged files with the file each came from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def copy_json(
    spark: SparkSession, path: str, columns: dict[str, tuple[str, str]], on_error: str = "abort"
) -> DataFrame:
    """Load staged JSON lines into typed columns given as name -> (path, type).

    ``abort`` fails the statement on the first malformed or wrongly typed value. ``skip_file`` leaves out every
    file that contains one.
    """
    lines = staged_lines(spark, path).where(has_content(F.col("value")))
    if on_error == "abort":
        event = F.parse_json("value")
        return lines.select(*[F.variant_get(event, p, t).alias(name) for name, (p, t) in columns.items()])
    if on_error != "skip_file":
        raise ValueError(f"on_error must be 'abort' or 'skip_file', not {on_error!r}")
    bad = stored_small(json_load_errors(lines, columns).select(F.col("source_file").alias("_bad")).distinct())
    good = lines.join(bad, F.col("source_file") == F.col("_bad"), "left_anti")
    event = F.try_parse_json("value")
    return good.select(*[F.try_variant_get(event, p, t).alias(name) for name, (p, t) in columns.items()])


def json_load_errors(lines: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Lines that would not load, with the reason; loads nothing."""
    event = F.try_parse_json("value")
    wrong = [
        F.when(
            F.try_variant_get(event, p, "variant").isNotNull()
            & (F.schema_of_variant(F.try_variant_get(event, p, "variant")) != "VOID")
            & F.try_variant_get(event, p, t).isNull(),
            F.lit(f"{name} is no {t}"),
        )
        for name, (p, t) in columns.items()
    ]
    reason = F.coalesce(F.when(event.isNull(), F.lit("invalid JSON")), *wrong)
    return computed_once(lines, {"error": reason}).where(F.col("error").isNotNull())


def validate_load(spark: SparkSession, path: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Errors a load of ``path`` would meet: ``source_file, value, error``."""
    lines = staged_lines(spark, path).where(has_content(F.col("value")))
    return json_load_errors(lines, columns).select("source_file", "value", "error")


def read_with_metadata(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Rows with file name, row number within the file (Parquet only), and load time."""
    rows = spark.read.format(file_format).load(path)
    meta = [F.col("_metadata.file_name").alias("source_file")]
    if file_format == "parquet":
        meta.append(F.col("_metadata.row_index").alias("file_row_number"))
    return rows.select("*", *meta, F.current_timestamp().alias("loaded_at"))


def load_history(bronze: DataFrame, since: Column | None = None) -> DataFrame:
    """Rows loaded per file and load time, from ``since`` on."""
    recent = bronze if since is None else bronze.where(F.col("loaded_at") >= since)
    return recent.groupBy("source_file", "loaded_at").agg(F.count("*").alias("row_count"))
