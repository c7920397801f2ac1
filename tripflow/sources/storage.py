"""Parquet layers: scan, inventory, partitioned write, incremental refresh, small written tables."""

from __future__ import annotations

import atexit
import fnmatch
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import schema
from tripflow.sources import records

LANDED_PATTERN = "trip_*.parquet"
PARTITIONS = ["year", "month"]
SOURCE = "source_file"


# --- shared folder -------------------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a folder of its own, gone at exit.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="tripflow-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tripflow/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the planner the true
    size: a join against the result is broadcast only while the files are under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it. Gone when the driver ends.
    """
    path = shared_path(df.sparkSession, name)
    hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- scan and inventory --------------------------------------------------------------------


def spread(scan: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer tasks than the session has cores; leave larger ones alone.

    A few files of one row group each would keep all later work in a few tasks. A scan that
    fills the cluster is never shuffled by this.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.isStreaming or scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores)


def _dataset(path: Column, pattern: str) -> Column:
    """The dataset a file belongs to: its folder if that name fits, itself if its own does, else null."""
    fits = fnmatch.translate(pattern)
    steps = F.split(path, "/")
    own_name, folder = F.element_at(steps, -1).rlike(fits), F.element_at(steps, -2).rlike(fits)
    return F.when(folder, F.regexp_replace(path, "/[^/]*$", "")).when(own_name, path)


def dataset_of(path: Column) -> Column:
    """The dataset a parquet file belongs to: the folder named ``*.parquet`` it is a part of, or itself.

    Partition folders between the two are passed over.
    """
    folder = F.regexp_replace(path, "(/[^/=]+=[^/]*)*/[^/]+$", "")
    return F.when(folder.rlike(r"\.parquet$"), folder).otherwise(path)


def _own_types(found: T.StructType) -> T.StructType:
    """The declared columns that ``found`` has, under their declared names and with its types."""
    by_name = {f.name.lower(): f.dataType for f in found}
    kinds = {f.name: by_name.get(f.name.lower(), T.NullType()) for f in schema.BRONZE}
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items() if kind != T.NullType()])


def scan_landed(
    spark: SparkSession, root: str, pattern: str = LANDED_PATTERN, with_source: bool = False
) -> DataFrame:
    """All landed datasets under ``root``, single files and Spark folders alike, with the declared types.

    Months differ in their types (integers of either width, counts as doubles). The datasets of
    one set of types are read together with these and cast; a value that does not fit comes back
    null, as does a column a dataset lacks. Types come from one footer of each dataset, through
    Spark's own reader. ``with_source`` adds the dataset's path as ``source_file``. Datasets outside
    the pattern are not opened; no dataset, no rows.
    """
    groups: dict[T.StructType, list[str]] = {}
    # One row per landed month, not per part file.
    for row in file_inventory(spark, root, pattern).collect():
        own = _own_types(spark.read.parquet(row["dataset"]).schema)
        groups.setdefault(own, []).append(row["dataset"])
    source = T.StructField(SOURCE, T.StringType())
    whole = T.StructType([*schema.BRONZE, source]) if with_source else schema.BRONZE
    scans = [spark.createDataFrame([], whole)]
    for own, paths in groups.items():
        columns = [
            (F.col(f.name).try_cast(f.dataType) if f.name in own.names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.BRONZE
        ]
        if with_source:
            columns.append(_dataset(F.col("_metadata.file_path"), pattern).alias(SOURCE))
        scans.append(spark.read.schema(own).parquet(*paths).select(*columns))
    return reduce(DataFrame.unionByName, scans[1:] or scans)


def scan_layer(spark: SparkSession, path: str, layer_schema: T.StructType | None = None) -> DataFrame:
    """A written layer; ``year`` and ``month`` come from the folders and prune partitions."""
    reader = spark.read if layer_schema is None else spark.read.schema(layer_schema)
    return reader.parquet(path)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Path and size of every parquet file under ``root``; no content is read."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(root)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, bytes bigint")
    return files.select("path", F.col("length").alias("bytes"))


def file_inventory(spark: SparkSession, root: str, pattern: str = LANDED_PATTERN) -> DataFrame:
    """Datasets under ``root``: files whose name fits ``pattern``, and folders of part files that do.

    A missing root has no datasets; a folder holding only ``_SUCCESS`` is none either.
    """
    return (
        list_files(spark, root)
        .select(_dataset(F.col("path"), pattern).alias("dataset"), "bytes")
        .where("dataset IS NOT NULL")
        .groupBy("dataset")
        .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
        .orderBy("dataset")
    )


def inventory_total(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count("*").alias("datasets"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )


FOOTERS_AT_ONCE = 16


def file_columns(files: DataFrame) -> DataFrame:
    """Column names of each listed file, as Spark's reader finds them in its footer: a small job a file, some at once.

    The session's file systems and credentials apply. The driver holds a path and its names per file, no content.
    """
    spark = files.sparkSession
    paths = [r["path"] for r in files.select("path").collect()]
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        names = list(pool.map(lambda path: spark.read.parquet(path).columns, paths))
    return spark.createDataFrame(list(zip(paths, names, strict=True)), "path string, columns array<string>")


# --- write and refresh ---------------------------------------------------------------------


def with_month(df: DataFrame, ts: str = schema.PICKUP) -> DataFrame:
    """Numeric partition columns, so that months sort and prune as numbers."""
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: list[str] = PARTITIONS,
    compression: str = "zstd",
    max_records: int = 0,
    mode: str = "overwrite",
    rebalance: bool = False,
) -> None:
    """Partitioned parquet write.

    Sources that come by month need no shuffle: a task holds few months and writes few files.
    For others, ``rebalance`` shuffles by month first, and AQE splits hot months and joins small ones.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).partitionBy(*partition_by)
    (
        writer.option("compression", compression)
        .option("maxRecordsPerFile", max_records)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def month_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(*PARTITIONS).agg(F.count("*").alias("rows"))


def _same(left: str, right: str, columns: list[str]) -> Column:
    """Equality of the columns of two aliased frames; nulls are equal."""
    return reduce(Column.__and__, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


#: Folder of a bronze layer with what was landed, per source; Spark's readers pass over it.
MANIFEST = "_landed"


def _layer_files(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and partition folder of a layer's files: a listing, no content."""
    return list_files(spark, path).select(
        F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("folder"), F.element_at(F.split("path", "/"), -1).alias("file"), "bytes"
    )


def _folders(files: DataFrame) -> DataFrame:
    """Per partition folder: files, bytes and an order-free hash of the names and sizes."""
    return files.groupBy("folder").agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum(F.xxhash64("file", "bytes").cast("decimal(38,0)")).cast("string").alias("names"),
    )


def land_months(
    bronze: DataFrame, path: str, source: str = SOURCE, rebalance: bool = False, run: records.Run | None = None
) -> DataFrame:
    """Write bronze in one job, then report rows per source and pickup month found in the files just written.

    The layer is partitioned by ``source``, the column that names the landed file (or its month):
    landing a file again replaces its own rows and no other's, also where files hold strays of each
    other's months. Pickup year and month are plain columns. A null pickup has null year and month.

    The input is read once, and of the layer only what this landing wrote. ``status`` is 'success' where the rows in
    the files are as many as the write counted; a difference makes all of this landing 'failed'. A manifest beside the
    layer keeps each source's rows and files. Sources landed before whose files are no longer those of the
    manifest are reported as 'failed' with -1 rows; this compares listings, and reads no content of theirs.
    """
    spark = bronze.sparkSession
    rows = with_month(bronze)
    keys = [source, *PARTITIONS]
    with records.recorded(run, "land_months") as stage:
        before = written(_layer_files(spark, path), "files-before")
        if rebalance:
            rows = rows.hint("rebalance", source)
        write_layer(stage.observe("written", rows), path, [source])
        listed = written(_layer_files(spark, path), "files-after")
        # One row per landed file or month, as in the inventory.
        own = [r["folder"] for r in listed.join(before, ["folder", "file"], "left_anti").select("folder").distinct().collect()]
        report = spark.createDataFrame([], T.StructType([*[rows.schema[k] for k in keys], T.StructField("rows", T.LongType())]))
        if own:
            landed = spark.read.schema(rows.schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in own])
            # Paths are taken apart once a file, not once a row.
            by_file = landed.groupBy(*keys, F.col("_metadata.file_path").alias("_file")).agg(F.count("*").alias("rows"))
            folder = F.max(_folder_of_file("_file")).alias("_folder")
            by_month = by_file.groupBy(*keys).agg(F.sum("rows").alias("rows"), folder)
            report = written(by_month, "landing")
        found = report.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
        status = "success" if found == stage.observed_rows("written") else "failed"
        stage.data_rows["found"] = found
        stage.artifacts["layer"] = path

        known = read_if_there(spark, f"{path}/{MANIFEST}")
        lost = report.limit(0).select(*keys, "rows").withColumn("status", F.lit("failed"))
        if known is not None:
            same = [F.col(f"k.{c}") == F.col(f"f.{c}") for c in ("folder", "files", "bytes", "names")]
            others = known.where(~F.col("folder").isin(own)) if own else known
            lost = (
                others.alias("k").join(_folders(listed).alias("f"), same, "left_anti")
                .select(*keys, F.lit(-1).cast("long").alias("rows"), F.lit("failed").alias("status"))
            )
            lost = written(lost, "lost")
        if own and status == "success":
            manifest = report.join(_folders(listed), F.col("_folder") == F.col("folder")).drop("_folder")
            # A folder of its own, as the manifest's partitions are named after the layer's.
            write_layer(manifest.coalesce(1), f"{path}/{MANIFEST}", ["folder"])
        stage.metrics["sources"] = len(own)
    return report.select(*keys, "rows", F.lit(status).alias("status")).unionByName(lost)


def _folder_of_file(path: str) -> Column:
    return F.regexp_extract(F.url_decode(path), "([^/]+)/[^/]+$", 1)


def read_if_there(spark: SparkSession, path: str, layer_schema: T.StructType | None = None) -> DataFrame | None:
    try:
        if layer_schema is None:
            return spark.read.parquet(path)
        return spark.read.schema(layer_schema).parquet(path).select(*layer_schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def pending_partitions(source_months: DataFrame, ledger: DataFrame, match: tuple[str, ...] = ("rows",)) -> DataFrame:
    """Source months the ledger does not show as committed with what they have now in the columns ``match``.

    Leftovers of a failed write stay pending, and a month that got late rows is pending again; one whose content was
    replaced by as many rows is if ``match`` has the digest.
    """
    committed = ledger.where("status = 'committed'").alias("c")
    return source_months.alias("s").join(committed, _same("s", "c", [*PARTITIONS, *match]), "left_anti")


def month_digests(source: DataFrame) -> DataFrame:
    """Rows and an order-free digest of all values per month. Equal rows count each; where nulls are counts too."""
    values = [F.col(f"`{c}`") for c in source.columns if c not in PARTITIONS]
    row_hash = F.xxhash64(*values, *[v.isNull() for v in values])
    return source.groupBy(*PARTITIONS).agg(F.count("*").alias("rows"), _exact_sum(row_hash).cast("string").alias("digest"))


def _exact_sum(number: Column) -> Column:
    """Sum of longs as a decimal that cannot overflow: three parts of 22 bits, as a sum of decimals costs an object a row."""
    part = F.lit((1 << 22) - 1)
    parts = (F.shiftright(number, 44), F.shiftright(number, 22).bitwiseAND(part), number.bitwiseAND(part))
    high, middle, low = (F.sum(p).cast("decimal(19,0)") for p in parts)
    return (high * F.lit(1 << 44) + middle * F.lit(1 << 22) + low).cast("decimal(38,0)")


def month_files(source: DataFrame) -> DataFrame | None:
    """An order-free digest of the path, size and time of each month's files, without reading content.

    None where ``source`` is not made of one scan of files.
    """
    if source._jdf.queryExecution().analyzed().collectLeaves().length() != 1:
        return None
    try:
        files = source.select(*PARTITIONS, *[f"_metadata.file_{c}" for c in ("path", "size", "modification_time")])
    except AnalysisException as error:
        if "UNRESOLVED_COLUMN" not in (error.getCondition() or ""):
            raise
        return None
    names = [c for c in files.columns if c not in PARTITIONS]
    digest = F.sum(F.xxhash64(*names).cast("decimal(38,0)")).cast("string")
    return files.distinct().groupBy(*PARTITIONS).agg(digest.alias("files"))


def months_condition(months: list[Row]) -> Column:
    """The listed months as a plain condition on the partition columns, so that the scan is pruned.

    A semi join with the list would read every partition: pruning at run time needs a filter on its side.
    """
    condition = F.lit(False)
    for year in sorted({m["year"] for m in months if m["year"] is not None}):
        of_year = sorted(m["month"] for m in months if m["year"] == year)
        condition = condition | ((F.col("year") == year) & F.col("month").isin(of_year))
    if any(m["year"] is None for m in months):
        condition = condition | F.col("year").isNull()
    return condition


def _partition_folder(month: Row) -> str:
    return "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if month[c] is None else month[c]}" for c in PARTITIONS)


def _partition_files(spark: SparkSession, path: str, months: list[Row]) -> dict[str, set[str]]:
    """File names in the folder of each month; one listing per month."""
    found = {}
    for folder in map(_partition_folder, months):
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        found[folder] = {f.getPath().getName() for f in system.listStatus(hadoop)} if system.exists(hadoop) else set()
    return found


def _drop_folders(spark: SparkSession, path: str, folders: list[str]) -> None:
    for folder in folders:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def refresh_layer(
    source: DataFrame,
    ledger_path: str,
    out_path: str,
    transform: Callable[[DataFrame], DataFrame],
    complete: bool = True,
    trust_files: bool = True,
    run: records.Run | None = None,
) -> DataFrame:
    """Process only pending months: replace their partitions, then their rows of the ledger.

    A month is pending if it is new, or its rows or their digest are not those committed. The digest is
    computed only for months whose files are not the committed ones either (path, size, time), so months at rest cost a
    listing; a month rewritten with the same content gets its new files noted and is not processed. Pass
    ``trust_files=False`` where ``source`` itself derives columns or filters rows in a way that may have changed.

    A pending month's partition is replaced as a whole, also by nothing: where ``transform`` keeps none of its rows, the old
    partition goes. So do those of months that ``source`` no longer has; their ledger rows become 'removed'. Pass
    ``complete=False`` if ``source`` holds only some of the months.

    ``source`` has ``year`` and ``month``; rows without a pickup time are a month of nulls. A crash
    before the last step leaves the months pending, and the next run does the same work again. The
    ledger is partitioned by month, so it holds one row for each. Returns the ledger rows of the months processed.
    """
    spark = source.sparkSession
    with records.recorded(run, "refresh_layer") as stage:
        ledger = read_if_there(spark, ledger_path, schema.REFRESH_LEDGER)
        # One row per calendar month here and below; kept, as the ledger's files are replaced further down.
        ledger = spark.createDataFrame([] if ledger is None else ledger.collect(), schema.REFRESH_LEDGER)
        files, changed = month_files(source) if trust_files else None, source
        if files is not None:
            files = spark.createDataFrame(files.collect(), files.schema)
            moved = pending_partitions(files, ledger, ("files",)).collect()
            changed = source.where(months_condition(moved))
        now = month_digests(changed)
        now = now.withColumn("files", F.lit(None).cast("string")) if files is None else (
            now.alias("n").join(files.alias("f"), _same("n", "f", PARTITIONS)).select("n.*", "files")
        )
        now = spark.createDataFrame(now.collect(), now.schema)
        pending = pending_partitions(now, ledger, ("rows", "digest")).collect()
        versions = {(m["year"], m["month"]): m["version"] or 0 for m in ledger.collect()}

        def committed(month: Row, status: str = "committed", more: int = 1) -> tuple:
            key = (month["year"], month["month"])
            there = status == "committed"
            rows, digest, names = (month["rows"], month["digest"], month["files"]) if there else (0, None, None)
            return (*key, rows, status, digest, names, versions.get(key, 0) + more)

        gone = []
        if complete:
            present = (month_counts(source) if files is None else files).alias("p")
            held = ledger.where("status = 'committed'").alias("l")
            gone = held.join(present, _same("l", "p", PARTITIONS), "left_anti").collect()
        commit = [committed(m) for m in pending] + [committed(m, "removed") for m in gone]
        at_rest = [committed(m, more=0) for m in now.collect() if m not in pending]

        before = _partition_files(spark, out_path, [*pending, *gone])
        if pending:
            result = with_month(transform(source.where(months_condition(pending))))
            write_layer(stage.observe("written", result), out_path)
            stage.observed_rows("written")
        after = _partition_files(spark, out_path, [*pending, *gone])
        emptied = [folder for folder, names in after.items() if names and names <= before[folder]]
        _drop_folders(spark, out_path, emptied)
        if commit or at_rest:
            write_layer(spark.createDataFrame(commit + at_rest, schema.REFRESH_LEDGER).coalesce(1), ledger_path)
        stage.data_rows["read"] = sum(m["rows"] for m in pending)
        stage.metrics |= {"months": len(pending), "emptied": len(emptied), "removed": len(gone)}
        stage.artifacts["layer"] = out_path
    return spark.createDataFrame(commit, schema.REFRESH_LEDGER)


# --- caps, samples, projections ------------------------------------------------------------


def cap_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in the order of a unique key, so the cap picks the same rows every run."""
    return df.orderBy(*order).limit(n)


def key_fraction(key: list[str], seed: int = 42) -> Column:
    """A number in [0, 1) fixed by the row's key and the seed, in any engine and any partitioning."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def sample_rows(df: DataFrame, fraction: float | None, key: list[str], seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement by key; only a fraction between 0 and 1 samples."""
    if fraction is None or not 0 < fraction < 1:
        return df
    return df.where(key_fraction(key, seed) < fraction)


def feature_target_view(df: DataFrame, target: str = schema.TARGET) -> DataFrame:
    """All other columns first, the target last."""
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found")
    return df.select(*[c for c in df.columns if c != target], target)
