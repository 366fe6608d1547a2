"""Session settings and lineage control."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Semantics every operator relies on: day boundaries in UTC, overflow raises,
# shuffles re-planned from measured sizes. The tokens of a URL are small groups, of which
# a task can hash many before it falls back to sorting.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}

# For many executors: start from many small shuffle partitions and let AQE merge
# them to the advisory size, so one setting serves ten rows and ten billion.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
}


def build_session(app_name: str = "tidewatch", *, master: str | None = None,
                  cluster: bool = False, conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the core settings; ``cluster=True`` adds the large-cluster ones."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**CORE_CONF, **(CLUSTER_CONF if cluster else {}), **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame, own_dir: str | None = None) -> DataFrame:
    """Reliable checkpoint of a small intermediate result that several outputs share.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; ``own_dir``
    is used only where that setting is absent.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or own_dir
        if folder is None:
            raise ValueError("set spark.checkpoint.dir or pass own_dir")
        context.setCheckpointDir(folder)
    return df.checkpoint()
