"""Object-store addressing (S3A, optional path-style access, optional TLS).

Settings go on the session builder as ``spark.hadoop.*`` so every executor
sees them; credentials are left to the cluster's credential providers unless
passed explicitly.

``Store`` addresses a folder of any Hadoop file system by a URI of its own, with
the file system's settings carried by the reads and writes themselves, so a
running session can reach a store it was not built for.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def with_s3a(builder: SparkSession.Builder, endpoint: str | None = None,
             access_key: str | None = None, secret_key: str | None = None,
             path_style: bool = True, ssl: bool = True) -> SparkSession.Builder:
    conf = {
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder


@dataclass(frozen=True)
class Store:
    """``root`` is a Hadoop URI, ``options`` its file system's settings
    (``fs.*``), for example S3A's endpoint; Spark hands them to every task."""
    root: str
    options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def mounted(cls, name: str, target: str) -> Store:
        """A view file system ``viewfs://name/`` over the folder ``target`` of
        any other file system, so jobs name their data by a stable URI while
        the mount table decides where it lies."""
        return cls(f"viewfs://{name}/data", {f"fs.viewfs.mounttable.{name}.link./data": target})

    def uri(self, path: str) -> str:
        return f"{self.root.rstrip('/')}/{path.lstrip('/')}"

    def write(self, df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options: str) -> str:
        uri = self.uri(path)
        df.write.mode(mode).options(**self.options, **options).format(fmt).save(uri)
        return uri

    def read(self, spark: SparkSession, path: str, schema, fmt: str = "parquet", **options: str) -> DataFrame:
        return spark.read.schema(schema).options(**self.options, **options).format(fmt).load(self.uri(path))
