"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` keys use ``__`` for dots."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Dates, hours and partition values all depend on the zone, so fix it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the length of a block.

    A streaming query copies the session when it starts, so wrapping ``start()`` is enough.
    """
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``.

    Executors must all see it, so a machine-local folder is only made in local mode.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tickloom-")
    return f"{base.rstrip('/')}/tickloom/{label}-{uuid.uuid4().hex}"
