"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app_name: str = "recordmill", **conf: str) -> SparkSession:
    """A session with the settings the operators were measured under.

    Results do not depend on any of them: dates and times are handled without
    the session time zone, and user text only meets ``try_*`` functions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; every executor has to reach it.

    Where it is unset, a session of one process (master ``local[n]``) gets a
    folder of its own; any other session is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = Path(tempfile.mkdtemp(prefix="recordmill-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_settled: list[str] = []


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from there.

    This cuts the lineage, so a lost executor costs no more than reading again,
    and what depended on partitioning is fixed. Unlike a checkpoint the table is
    columnar: a later pass over one column reads that column only. The tables
    stay until ``release``.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    to_release(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def to_release(path: str) -> None:
    """Have ``release`` delete a table or folder that was written on the way."""
    _settled.append(path)


def settled_tables() -> int:
    """How many settled tables there are, for ``release`` to delete only later ones."""
    return len(_settled)


def release(spark: SparkSession, begun: int = 0, newest: int = 0) -> None:
    """Delete the tables settled since there were ``begun``, but for the ``newest``; call it when what was made of them is written."""
    hadoop, kept = spark._jvm.org.apache.hadoop.fs.Path, len(_settled) - newest
    gone, _settled[begun:] = _settled[begun:kept], _settled[max(begun, kept) :]
    for name in gone:
        path = hadoop(name)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
