"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_READ_MB = 256

# Hadoop S3A option names and the settings used for large Parquet reads and safe commits.
OBJECT_STORE_CONF = {
    "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    "spark.hadoop.fs.s3a.path.style.access": "false",
    "spark.hadoop.fs.s3a.connection.ssl.enabled": "true",
    "spark.hadoop.fs.s3a.experimental.fadvise": "random",
    "spark.hadoop.fs.s3a.committer.name": "magic",
    "spark.hadoop.fs.s3a.committer.magic.enabled": "true",
}


def session_conf(
    read_partition_mb: int = DEFAULT_READ_MB,
    object_store: bool = False,
    access_key: str | None = None,
    secret_key: str | None = None,
) -> dict[str, str]:
    """Settings every job uses; `object_store` adds the S3A preset."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(read_partition_mb * 1024 * 1024),
    }
    if object_store:
        conf.update(OBJECT_STORE_CONF)
        if access_key and secret_key:
            conf["spark.hadoop.fs.s3a.access.key"] = access_key
            conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def build_session(
    app_name: str = "flowlens",
    master: str | None = None,
    extra: dict[str, str] | None = None,
    **conf_args,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**session_conf(**conf_args), **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for local sessions that name none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="flowlens-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared root."""
    return f"{shared_root(spark)}/flowlens/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers find the package where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}" if known else root
