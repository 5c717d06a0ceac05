"""Settings that let every ``s3a://`` path reach an S3-compatible store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def object_store_settings(
    endpoint: str,
    access_key: str,
    secret_key: str,
    use_ssl: bool = False,
    path_style: bool = True,
    region: str = "us-east-1",
) -> dict[str, str]:
    """Configuration entries for the session builder or spark-submit."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.endpoint.region": region,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(use_ssl).lower(),
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }


def with_object_store(builder: SparkSession.Builder, **settings) -> SparkSession.Builder:
    for key, value in object_store_settings(**settings).items():
        builder = builder.config(key, value)
    return builder
