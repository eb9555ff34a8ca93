"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, Observation, SparkSession
from pyspark.sql import functions as F


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC days and ANSI errors; every timestamp and cast below relies on both."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """The path of a fresh folder for ``name``, which all executors share.

    It lies in the folder that ``spark.checkpoint.dir`` names, or in the warehouse where the session
    names none; either is shared by definition. What an application leaves there goes when it ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    own = f"{re.sub('^file:/+', 'file:///', base.rstrip('/'))}/stratiform-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def observed(observation: Observation) -> dict | None:
    """Metrics of a finished job. None if there are none: adaptive execution drops the observed
    part of a plan once it finds that its result is empty."""
    try:
        return observation.get
    except Py4JJavaError:
        return None


def moment(value: Column | dt.datetime | str | None) -> Column:
    """``as_of`` arguments as a timestamp column; None is the current time."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.isoformat()
    return F.lit(value).cast("timestamp")
