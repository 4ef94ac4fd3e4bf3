"""Table sinks K1-K14 on the session catalog.

Delta is not assumed: tables are created with a provider parameter
(parquet by default). Everything here is catalog metadata or a Spark write;
no data passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schema_merge import conformed_rows, merged_schema


def _lit(value: object) -> str:
    """SQL string literal (doubled quote, doubled backslash)."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "''") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def table_exists(spark: SparkSession, table: str) -> bool:
    """S10."""
    return spark.catalog.tableExists(table)


def ensure_table(spark: SparkSession, table: str, fields: list[tuple[str, str]], *,
                 provider: str = "parquet", partition_by: list[str] | None = None) -> list[str]:
    """K2 + K3: create the table with an explicit schema when absent, else
    add the columns it lacks. Returns the names of added columns."""
    if not table_exists(spark, table):
        cols = ", ".join(f"{_ident(n)} {t.upper()}" for n, t in fields)
        part = f" PARTITIONED BY ({', '.join(_ident(c) for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {table} ({cols}) USING {provider}{part}")
        return []
    have = {f.name.lower() for f in spark.table(table).schema.fields}
    missing = [(n, t) for n, t in fields if n.lower() not in have]
    if missing:
        add = ", ".join(f"{_ident(n)} {t.upper()}" for n, t in missing)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({add})")
    return [n for n, _ in missing]


def align_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in its order: present ones cast, absent ones null."""
    have = {c.lower(): c for c in df.columns}
    extra = [c for c in df.columns if c.lower() not in {f.name.lower() for f in schema.fields}]
    if extra:
        raise ValueError(f"columns not in the target table: {extra}")
    return df.select(*[
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def append_by_name(df: DataFrame, table: str) -> None:
    """K1: append matching columns by name; table columns the frame lacks
    are written as null."""
    spark = df.sparkSession
    target = spark.table(table).schema
    align_to(df, target).write.insertInto(table)


def replace_table(df: DataFrame, table: str, *, merge_schema: bool = True) -> None:
    """K4: overwrite the table's rows; with ``merge_schema`` the table's new
    schema is the merge of both at every depth (``sinks.schema_merge``): what
    only the old table has is kept, as nulls, after the new columns, and types
    widen, never narrow.

    Only the old *schema* is read. A frame computed from the table itself
    must be materialised first (see ``runlens.session.cut_lineage``).
    """
    out = df
    if merge_schema and table_exists(df.sparkSession, table):
        out = conformed_rows(df, merged_schema(df.schema, df.sparkSession.table(table).schema))
    out.write.mode("overwrite").saveAsTable(table)


def append_conformed(df: DataFrame, table: str) -> None:
    """K1 for nested rows: append what fits the table's schema at every depth;
    a value that would be narrowed, or a field the table lacks, raises."""
    conformed_rows(df, df.sparkSession.table(table).schema).write.insertInto(table)


def overwrite_table(df: DataFrame, table: str) -> None:
    """K5: overwrite rows and schema."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def comment_table(spark: SparkSession, table: str, comment: str) -> None:
    """K9."""
    spark.sql(f"COMMENT ON TABLE {table} IS {_lit(comment)}")


def set_table_tags(spark: SparkSession, table: str, tags: dict[str, object]) -> None:
    """Tags as table properties."""
    if tags:
        props = ", ".join(f"{_lit(k)}={_lit(v)}" for k, v in tags.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({props})")


def comment_columns(spark: SparkSession, table: str, comments: dict[str, str]) -> None:
    """K11."""
    for col, text in comments.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {_ident(col)} COMMENT {_lit(text)}")


def tag_columns(spark: SparkSession, table: str, tags: dict[str, dict[str, object]]) -> None:
    """Column tags, stored as table properties ``column.<col>.tag.<key>``
    (open-source Spark has no column tag statement)."""
    flat = {f"column.{col}.tag.{k}": v for col, kv in tags.items() for k, v in (kv or {}).items()}
    set_table_tags(spark, table, flat)


def table_properties(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {table}")


def laid_out(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """The log's layout advice - one folder per end date, rows clustered
    by job, run and task id inside each file.

    Range partitioning on (end date, ids) balances tasks by sampled key
    ranges, so a hot day spreads over several writers instead of one.
    """
    d = df.withColumn("end_date", F.to_date(F.substring("job_end_datetime_iso", 1, 10)))
    keys = ["end_date", "job_id", "run_id", "child_task_run_id"]
    d = d.repartitionByRange(partitions, *keys) if partitions else d.repartitionByRange(*keys)
    return d.sortWithinPartitions(*keys)


def write_laid_out(df: DataFrame, table: str, partitions: int | None = None) -> None:
    laid_out(df, partitions).write.mode("append").partitionBy("end_date").saveAsTable(table)
