"""Landing layer: append-only JSON log of record versions.

Records are kept as raw JSON text inside a fixed envelope and never schema-inferred:
inference once turned offset timestamps into naive ones. The log is partitioned by
``ingest_date``; every read declares its schema, and a dataset that has never been
landed reads as an empty frame *with* that schema, so downstream plans still bind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from repsmith.functions.json import content_hash, record_id
from repsmith.functions.scalars import run_stamp

ENVELOPE = T.StructType([
    T.StructField("_ingested_at", T.StringType()),
    T.StructField("_run_id", T.StringType()),
    T.StructField("_endpoint", T.StringType()),
    T.StructField("_record_id", T.StringType()),
    T.StructField("_record_hash", T.StringType()),
    T.StructField("record", T.StringType()),
])

# Dataset name -> source endpoint.
DATASETS = {
    "workouts": "/v1/workouts",
    "workout_events": "/v1/workouts/events",
    "routines": "/v1/routines",
    "routine_folders": "/v1/routine_folders",
    "exercise_templates": "/v1/exercise_templates",
}


def envelope(records: DataFrame, dataset: str, run_id: str | Column | None = None,
             ingested_at: Column | None = None, record_col: str = "record", identified: bool = False) -> DataFrame:
    """Stamp raw JSON records with the landing envelope (run, endpoint, id, content hash). ``identified``:
    the records carry ``record_id`` and ``record_hash`` of ``ingest.identify``, which are not made again."""
    ts = ingested_at if ingested_at is not None else F.current_timestamp()
    run = run_id if isinstance(run_id, Column) else (F.lit(run_id) if run_id else run_stamp(ts))
    return records.select(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("_ingested_at"),
        run.alias("_run_id"),
        F.lit(DATASETS.get(dataset, dataset)).alias("_endpoint"),
        (F.col("record_id") if identified else record_id(record_col)).alias("_record_id"),
        (F.col("record_hash") if identified else content_hash(record_col)).alias("_record_hash"),
        F.col(record_col).alias("record"),
        F.to_date(ts).alias("ingest_date"))


def land(records: DataFrame, base_path: str, dataset: str, run_id: str | None = None,
         ingested_at: Column | None = None, identified: bool = False) -> None:
    """Append records to ``base_path/dataset/ingest_date=YYYY-MM-DD/`` as JSON lines."""
    (envelope(records, dataset, run_id, ingested_at, identified=identified)
     .write.mode("append").partitionBy("ingest_date").json(f"{base_path.rstrip('/')}/{dataset}"))


def read_landed(spark: SparkSession, base_path: str, dataset: str) -> DataFrame:
    """Landed JSON with the declared envelope schema and the ``ingest_date`` partition.
    Missing dataset -> empty frame with the schema."""
    schema = T.StructType(ENVELOPE.fields + [T.StructField("ingest_date", T.DateType())])
    path = f"{base_path.rstrip('/')}/{dataset}"
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def bronze(landed: DataFrame) -> DataFrame:
    """Typed bronze table from the envelope: instants cast on read (S3)."""
    return landed.select(
        F.col("_ingested_at").cast("timestamp").alias("ingested_at"),
        F.col("_run_id").alias("run_id"),
        F.col("_endpoint").alias("endpoint"),
        F.col("_record_id").alias("record_id"),
        F.col("_record_hash").alias("record_hash"),
        "record", "ingest_date")


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed CSV seed with a header (S4): dates and booleans declared, never inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Query result -> CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def run_summary(landed: dict[str, DataFrame]) -> DataFrame:
    """Per dataset and run: records landed."""
    out = None
    for name, df in landed.items():
        part = df.groupBy(F.lit(name).alias("dataset"), F.col("_run_id").alias("run_id")).agg(
            F.count(F.lit(1)).cast("long").alias("n_records"))
        out = part if out is None else out.unionByName(part)
    return out
