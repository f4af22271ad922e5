"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "supplylens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans in this library assume.

    Shuffle partition counts are left to the cluster: AQE coalesces small ones
    and splits skewed ones, so only tests and the bench pin a number.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else a folder in the warehouse.

    Both settings name shared storage on a cluster, so one rule holds for every master.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if not named:
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set(CHECKPOINT_CONF, named)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def path_kind(spark: SparkSession, path: str) -> str | None:
    """"folder", "file" or None, in whatever store the path names."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(where):
        return None
    return "folder" if store.getFileStatus(where).isDirectory() else "file"


def drop_folder(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody has written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, none if there is no such folder."""
    if path_kind(spark, path) != "folder":
        return []
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in store.listStatus(where))


def read_file(spark: SparkSession, path: str) -> str:
    """Content of a small file, in whatever store the path names."""
    return spark.read.text(path, wholetext=True).first()[0]


def new_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all; FileExistsError if another writer was first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, name = path.rsplit("/", 1)
    spare, final = jvm.org.apache.hadoop.fs.Path(f"{folder}/_{name}-{uuid.uuid4().hex[:12]}"), jvm.org.apache.hadoop.fs.Path(path)
    out = final.getFileSystem(conf).create(spare, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never_over = spark.sparkContext._gateway.new_array(rename, 1)
    never_over[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf).rename(spare, final, never_over)
    except Exception as failed:
        final.getFileSystem(conf).delete(spare, False)
        if path_kind(spark, path):
            raise FileExistsError(path) from failed
        raise
