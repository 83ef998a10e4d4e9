"""Session settings, the folder all executors share, and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a relation may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def session(app: str = "quaystone", cpus: int | str = "*", partitions: int = 8, warehouse: str | Path | None = None) -> SparkSession:
    """A local session for tests and benches, its warehouse folder a temporary one if none is given; a cluster brings its own."""
    if warehouse is None:
        warehouse = tempfile.mkdtemp(prefix="quaystone-warehouse-")
        atexit.register(shutil.rmtree, warehouse, True)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", f"file://{Path(warehouse).absolute()}")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that their Python workers can import it wherever it is installed here."""
    context = spark.sparkContext
    if getattr(context, "_quaystone_sent", False):
        return
    root = Path(__file__).resolve().parent
    own = tempfile.mkdtemp(prefix="quaystone-zip-")
    atexit.register(shutil.rmtree, own, True)
    archive = f"{own}/quaystone.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(archive)
    context._quaystone_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary folder only where none is set and all of Spark runs on this machine."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(spark, "_quaystone_dir", None)
    if own is None:
        own = tempfile.mkdtemp(prefix="quaystone-")
        spark._quaystone_dir = own
        atexit.register(shutil.rmtree, own, True)
    return f"file://{own}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quaystone-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _forget_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _forget_at_end(spark: SparkSession, path: str) -> None:
    """Have the driver's file system client remove a folder, on whatever storage, when the driver ends."""
    try:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    except AttributeError:  # a remote session reaches no JVM; its cluster clears the shared folder
        pass


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan with at least four partitions per core, for long work per row; larger scans have them already and stay as they are."""
    want = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want, key)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """df with further columns that are computed once, however often later expressions name them.

    They pass through a generator of one row, into which the optimiser inlines nothing; plain projections would be
    collapsed into one expression that repeats them and outgrows the code limit.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def pick(df: DataFrame, names: list[str], labels: list[str] | None = None) -> DataFrame:
    """The named columns, under labels if given, whatever else df holds.

    A column of the exact name goes before one that differs in case, and the first of several equal ones is taken, so that
    further columns with clashing names do no harm.
    """
    have, low = df.columns, [c.lower() for c in df.columns]
    at = [have.index(n) if n in have else low.index(n.lower()) for n in names]
    labels = labels or names
    if len(set(low)) < len(low):
        df = df.toDF(*[f"_{i}" for i in range(len(have))])
        return df.select(*[F.col(f"_{i}").alias(x) for i, x in zip(at, labels, strict=True)])
    return df.select(*[F.col("`" + have[i].replace("`", "``") + "`").alias(x) for i, x in zip(at, labels, strict=True)])


def once(df: DataFrame, key: list[str]) -> DataFrame:
    """df with rows delivered twice only once: they repeat whole, so all columns are compared.

    Rows that share a key and differ in anything are different rows and all stay. Where df is partitioned by a part of its
    columns already, nothing is shuffled.
    """
    return df.select(*key, *[c for c in df.columns if c not in key]).distinct()


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """df with a broadcast hint if it has at most `rows` rows, and whether it has.

    The check reads one row beyond the bound and no more; a larger relation is left to a shuffle join.
    """
    small = df.limit(rows + 1).count() <= rows
    return (F.broadcast(df) if small else df), small
