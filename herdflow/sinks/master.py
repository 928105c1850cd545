"""Master upsert (keep latest per key, day-partitioned), exports, month bundle, run log."""

from __future__ import annotations

import contextlib
import datetime as dt
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from herdflow.operators.dedup import HERD_TIEBREAK, TIEBREAK, dedup_latest, latest_order
from herdflow.schemas import DEDUP_KEYS, MASTER_ORDER, RUN_LOG_SCHEMA
from herdflow.session import delete_path, hadoop_fs, path_exists

# Day partitions: a run rewrites only the days its batch touches (the re-fetch window),
# and a month report prunes by a range on the same column.
PARTITION_COL = "day"
NULL_NAME = "__HIVE_DEFAULT_PARTITION__"
STAGING_DIR = "_staging"


def with_partition(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Day partition value (``yyyy-MM-dd`` text); a null date lands in the null partition."""
    return df.withColumn(PARTITION_COL, F.date_format(F.col(date_col).cast("date"), "yyyy-MM-dd").cast("string"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read the day-partitioned table with the partition column pinned to text (type
    inference would make it VOID when only the null partition exists)."""
    df = spark.read.option("mergeSchema", "true").parquet(path)      # days may differ in columns
    if PARTITION_COL in df.columns and not isinstance(df.schema[PARTITION_COL].dataType, T.StringType):
        schema = T.StructType([T.StructField(PARTITION_COL, T.StringType()) if f.name == PARTITION_COL else f
                               for f in df.schema.fields])
        df = spark.read.schema(schema).parquet(path)
    return df


def _write_partitioned(df: DataFrame, path: str) -> None:
    """One task writes few days and a day comes from few tasks: rows are rebalanced by day
    (a large day is split by size, small ones share a task) and sorted before the write."""
    order = [c for c in MASTER_ORDER if c in df.columns]
    (df.hint("rebalance", PARTITION_COL).sortWithinPartitions(PARTITION_COL, *order)
     .write.mode("overwrite").partitionBy(PARTITION_COL).parquet(path))


def has_data(spark: SparkSession, path: str, col: str = PARTITION_COL) -> bool:
    """Whether the folder holds partitions of the table (an empty folder, or one with
    markers or stages only, counts as no table)."""
    if not path_exists(spark, path):
        return False
    jvm, fs = _fs(spark, path)
    return any(st.isDirectory() and st.getPath().getName().startswith(col + "=")
               for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(path)))


LOCK = "_LOCK"
LOCK_SECONDS = 6 * 3600


class Lock:
    """The writer's lock of a table: a file that holds its owner's id and is touched while the owner lives.

    Only the owner's lock is ever deleted by it. A lock that was not touched for `stale` seconds belongs
    to a run that died; whoever creates the file that claims this very owner's lock takes it over, and
    looks again before it deletes, so of two runs that see the same stale lock one wins.
    """

    def __init__(self, spark: SparkSession, path: str, stale: float = LOCK_SECONDS):
        self.path, self.stale, self.owner = path, stale, uuid.uuid4().hex
        self.jvm, self.fs = _fs(spark, path)
        self.file = self._file(LOCK)

    def _file(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def held_by(self) -> tuple[str, float] | None:
        """The owner of the lock there is, and the seconds since it was touched."""
        try:
            age = time.time() - self.fs.getFileStatus(self.file).getModificationTime() / 1000
            stream = self.fs.open(self.file)
        except Py4JJavaError:                    # none, or just gone
            return None
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"), age
        finally:
            stream.close()

    def _create(self) -> bool:
        try:
            out = self.fs.create(self.file, False)
        except Py4JJavaError:                    # another run has created it
            return False
        out.write(bytearray(self.owner.encode()))
        out.close()
        seen = self.held_by()
        return seen is not None and seen[0] == self.owner

    def acquire(self) -> bool:
        seen = self.held_by()
        if seen is None:
            return self._create()
        owner, age = seen
        if age <= self.stale:
            return False
        claim = self._file(f"{LOCK}_claim_{owner or 'nobody'}")
        if not self.fs.createNewFile(claim):
            return False
        try:
            again = self.held_by()
            if again is None or again[0] != owner or again[1] <= self.stale:
                return False
            self.fs.delete(self.file, False)
            return self._create()
        finally:
            self.fs.delete(claim, False)

    def renew(self) -> bool:
        """Touch the lock if it is still one's own."""
        seen = self.held_by()
        if seen is None or seen[0] != self.owner:
            return False
        self.fs.setTimes(self.file, int(time.time() * 1000), -1)
        return True

    def release(self) -> None:
        seen = self.held_by()
        if seen is not None and seen[0] == self.owner:
            self.fs.delete(self.file, False)


@contextlib.contextmanager
def writing(spark: SparkSession, path: str, stale: float = LOCK_SECONDS) -> Iterator[Lock]:
    """One writer at a time (`Lock`). A second writer gets an error and has changed nothing; the lock is renewed
    while the block runs, however long, and a run that has lost it gets an error when it ends."""
    lock = Lock(spark, path, stale)
    if not lock.acquire():
        raise RuntimeError(f"another run is writing to {path}")
    done = threading.Event()

    def keep() -> None:
        while not done.wait(stale / 10):
            lock.renew()

    keeper = threading.Thread(target=keep, daemon=True)
    keeper.start()
    try:
        yield lock
        if not lock.renew():
            raise RuntimeError(f"the lock of {path} was lost")
    finally:
        done.set()
        keeper.join()
        lock.release()


def _fs(spark: SparkSession, path: str):
    return hadoop_fs(spark, path)


def swap_partitions(spark: SparkSession, stage: str, path: str, col: str = PARTITION_COL) -> list[str]:
    """Move every ``col=value`` folder of a complete stage into the table, replacing the
    table's folder of the same value (delete, then rename). Data is written once (into the
    stage); the swap is metadata work. Returns the swapped folder names."""
    jvm, fs = _fs(spark, stage)
    folders = [st.getPath() for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(stage))
               if st.isDirectory() and st.getPath().getName().startswith(col + "=")]

    def move(source) -> str:
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/{source.getName()}")
        if fs.exists(target):
            fs.delete(target, True)
        if not fs.rename(source, target):
            raise RuntimeError(f"could not move {source} to {target}")
        return source.getName()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(move, folders))


COMMITTED = "_COMMITTED"


def mark_committed(spark: SparkSession, stage: str) -> None:
    """Completion marker of a stage, written after its job has finished (independent of
    whether the output committer writes ``_SUCCESS``); readers skip ``_`` files."""
    jvm, fs = _fs(spark, stage)
    fs.create(jvm.org.apache.hadoop.fs.Path(f"{stage}/{COMMITTED}"), True).close()


def recover_staged(spark: SparkSession, path: str, col: str = PARTITION_COL) -> bool:
    """Finish an upsert that stopped after staging: a complete stage (marked
    ``_COMMITTED``) is swapped in (again); an incomplete one is discarded."""
    stage_root = f"{path}/{STAGING_DIR}"
    if not path_exists(spark, stage_root):
        return False
    jvm, fs = _fs(spark, stage_root)
    done = False
    for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(stage_root)):
        stage = st.getPath().toString()
        if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{stage}/{COMMITTED}")):
            swap_partitions(spark, stage, path, col)
            done = True
        delete_path(spark, stage)
    return done


def staged_partitions(spark: SparkSession, path: str, col: str = PARTITION_COL) -> list:
    """Partition values present under a partitioned folder, from one listing of its root
    (no data is read). The null partition is returned as None."""
    jvm, fs = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(path)) if st.isDirectory()]
    values = {n[len(col) + 1:] for n in names if n.startswith(col + "=")}
    return sorted((None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values), key=lambda v: (v is None, v))


def master_order(df: DataFrame) -> list[Column]:
    """Newest load first; ties are settled by all columns that rows of one key can differ in
    (two herd rows of one tag, for instance), so the survivor doesn't depend on row order."""
    if "loaded_at" not in df.columns:
        df = df.withColumn("loaded_at", F.lit(None))
    rest = [c for c in HERD_TIEBREAK if c in df.columns]
    more = sorted(c for c in df.columns if c not in (*DEDUP_KEYS, *TIEBREAK, *rest, "loaded_at", PARTITION_COL))
    return latest_order(tiebreak=tuple(c for c in (*TIEBREAK, *rest, *more) if c in df.columns))


@dataclass
class Upsert:
    """What an upsert did: the table (of a dry run: the would-be days), and the days it touched (None: without a date)."""

    table: DataFrame
    days: list[str | None]


def upsert_latest(new: DataFrame, path: str, keys: list[str] = DEDUP_KEYS,
                  order: list[Column] | None = None, write: bool = True, date_col: str = "date") -> DataFrame:
    """The table after `upsert_days`."""
    return upsert_days(new, path, keys, order, write, date_col).table


def upsert_days(new: DataFrame, path: str, keys: list[str] = DEDUP_KEYS,
                order: list[Column] | None = None, write: bool = True, date_col: str = "date") -> Upsert:
    """existing ∪ new -> keep the latest row per key -> replace only the touched days.

    * The incoming batch is computed once: it is written to a staging folder next to the
      table (partitioned by day), and the touched days are read from that folder's
      listing, so the upstream transform never runs twice.
    * Only the touched day partitions of the table are read (partition pruning) and
      replaced; other days are never touched — a daily run with a 7-day re-fetch window
      replaces about 9 day folders, not whole months.
    * `keys` must contain the date: only then does the dedup need no rows of other days.
    * Columns of either side stay; rows without them get nulls.
    * The merged days are written once, into a stage in the table's own layout, and then
      swapped in folder by folder (delete + rename: no second copy of the data). A first
      load goes the same way. The table is never read and written by the same job; a run
      that stops during the swap is finished by `recover_staged` on the next run (the stage
      stays until the swap is done).
    * One run writes at a time (`writing`).
    * ``write=False`` is the dry run: returns the would-be merged days lazily and changes
      nothing, stages of stopped runs included.
    """
    if date_col not in keys:
        raise ValueError(f"the keys must contain {date_col!r}: days are replaced one by one")
    spark = new.sparkSession
    new_m = with_partition(new, date_col)
    if not write:
        touched = [r[0] for r in new_m.select(PARTITION_COL).distinct().collect()] if has_data(spark, path) else []
        return Upsert(_merged(spark, path, new_m, touched, keys, order), touched)
    jvm, fs = _fs(spark, path)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(path))
    with writing(spark, path):
        delete_path(spark, f"{path}/{STAGING_DIR}_in")          # batches of stopped runs
        recover_staged(spark, path)
        run = uuid.uuid4().hex[:12]
        batch_path = f"{path}/{STAGING_DIR}_in/{run}"
        new_m.hint("rebalance", PARTITION_COL).write.partitionBy(PARTITION_COL).parquet(batch_path)
        batch = spark.read.schema(new_m.schema).parquet(batch_path)   # known schema: may be empty
        touched = staged_partitions(spark, batch_path)
        if touched:
            stage = f"{path}/{STAGING_DIR}/{run}"
            _write_partitioned(_merged(spark, path, batch, touched, keys, order), stage)
            mark_committed(spark, stage)
            swap_partitions(spark, stage, path)
            delete_path(spark, stage)
        delete_path(spark, f"{path}/{STAGING_DIR}_in")
    return Upsert(read_table(spark, path) if has_data(spark, path) else new_m.limit(0), touched)


def refresh_partitions(rows: DataFrame, path: str, col: str, values: list[str]) -> None:
    """Replace the partitions `values` of a table by `rows` (which are theirs only); one that has no rows any more becomes empty.

    Staged, marked and swapped like an upsert; files of other partitions are not touched.
    """
    spark = rows.sparkSession
    jvm, fs = _fs(spark, path)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(path))
    with writing(spark, path):
        recover_staged(spark, path, col)
        _replace(spark, rows, path, col, values)


def _replace(spark: SparkSession, rows: DataFrame, path: str, col: str, values: list[str | None]) -> None:
    if not values:
        return
    jvm, fs = _fs(spark, path)
    stage = f"{path}/{STAGING_DIR}/{uuid.uuid4().hex[:12]}"
    rows.hint("rebalance", col).sortWithinPartitions(col).write.partitionBy(col).parquet(stage)
    for v in values:
        fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{stage}/{col}={NULL_NAME if v is None else v}"))
    mark_committed(spark, stage)
    swap_partitions(spark, stage, path, col)
    delete_path(spark, stage)


def changed_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """(day, n_before, n_after, n_changed) of the days whose rows differ as a bag: by the number of rows and, a column at
    a time, the sum of hashes. `n_changed` counts the columns that differ. Both sides carry `day`."""
    cols = [c for c in before.columns if c != PARTITION_COL]

    def marks(df: DataFrame, side: str) -> DataFrame:
        # the place of a row's other cells goes into each cell's hash, so that values cannot trade rows unseen
        sums = [F.sum(F.xxhash64(F.lit(c), F.col(c).cast("string"), F.col(c).isNull(), "_row").cast("decimal(38,0)")).alias(f"{side}{c}")
                for c in cols]
        keyed = df.withColumn("_row", F.xxhash64(*[F.col(c).cast("string") for c in DEDUP_KEYS if c in cols and c != "device"]))
        return keyed.groupBy(PARTITION_COL).agg(F.count(F.lit(1)).alias(f"{side}rows"), *sums).withColumnRenamed(PARTITION_COL, f"{side}{PARTITION_COL}")

    b, a = marks(before, "b_"), marks(after, "a_")
    both = b.join(a, F.col(f"b_{PARTITION_COL}").eqNullSafe(F.col(f"a_{PARTITION_COL}")), "full_outer")
    differ = [(~F.col(f"b_{c}").eqNullSafe(F.col(f"a_{c}"))).cast("int") for c in cols]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(f"n_{'before' if c[0] == 'b' else 'after'}")
    return (both.select(F.coalesce(f"b_{PARTITION_COL}", f"a_{PARTITION_COL}").alias(PARTITION_COL), zero("b_rows"), zero("a_rows"),
                        sum(differ, F.lit(0)).alias("n_changed"))
            .where((F.col("n_before") != F.col("n_after")) | (F.col("n_changed") > 0)))


def write_back(spark: SparkSession, path: str, repair: Callable[[DataFrame], DataFrame], write: bool = True) -> DataFrame:
    """Apply a repair to the master and rewrite only the days that it changes.

    `repair` takes and returns rows of the master without `day`, and needs no rows of other days (the keys hold the
    date). What changes is found first, from a count and sums of hashes a day; changed days go through a marked stage
    and the swap, all others keep their files; where nothing changes nothing is written. Returns the changed days
    (`changed_days`) as local rows. ``write=False`` only says what would change.
    """
    def repaired(df: DataFrame) -> DataFrame:
        return with_partition(repair(df.drop(PARTITION_COL))).select(*df.columns)

    def found() -> list:
        master = read_table(spark, path)
        return changed_days(master, repaired(master)).collect()             # a row a day

    schema = "day string, n_before bigint, n_after bigint, n_changed int"
    if not write:
        return spark.createDataFrame(found(), schema)
    with writing(spark, path):
        recover_staged(spark, path)
        days = found()
        names = [r[PARTITION_COL] for r in days]
        hit = F.col(PARTITION_COL).isin([d for d in names if d is not None])
        hit = hit | F.col(PARTITION_COL).isNull() if None in names else hit
        _replace(spark, repaired(read_table(spark, path).where(hit)), path, PARTITION_COL, names)
    return spark.createDataFrame(days, schema)


def _merged(spark: SparkSession, path: str, batch: DataFrame, touched: list, keys: list[str],
            order: list[Column] | None) -> DataFrame:
    """The touched days with the batch merged in."""
    combined = batch
    if has_data(spark, path):
        cond = F.col(PARTITION_COL).isin([m for m in touched if m is not None])
        if None in touched:
            cond = cond | F.col(PARTITION_COL).isNull()
        existing = read_table(spark, path).where(cond)
        combined = existing.unionByName(batch, allowMissingColumns=True)
    order = order if order is not None else master_order(combined)
    if "loaded_at" in combined.columns:
        return dedup_latest(combined, keys, order)
    return dedup_latest(combined.withColumn("loaded_at", F.lit(None)), keys, order).drop("loaded_at")


def export_csv(df: DataFrame, path: str, order: list[str] | None = None, write: bool = True) -> DataFrame:
    """CSV export with header; the commit protocol makes it all-or-nothing. Returns the rows
    in their order; ``write=False`` writes nothing."""
    out = df.orderBy(*order) if order else df
    if write:
        out.write.mode("overwrite").option("header", True).csv(path)
    return out


def write_month_bundle(frames: dict[str, DataFrame], path: str, month: str, write: bool = True) -> str:
    """Write each named frame to ``path/month=YYYYMM/<name>`` (same month overwrites).

    Returns the name of the import file: ``clean_re_outlier`` unless it is empty, then
    ``clean_csv``. ``write=False`` writes nothing.
    """
    for name, df in frames.items() if write else ():
        df.write.mode("overwrite").parquet(f"{path}/month={month}/{name}")
    clean = frames.get("clean_re_outlier")
    return "clean_re_outlier" if clean is not None and not clean.isEmpty() else "clean_csv"


def append_run_log(spark: SparkSession, path: str, rows: list[tuple]) -> DataFrame:
    """Append job status rows (job_name, device, status, duration, msg); newline in the
    message -> space, duration rounded to 2 decimals."""
    now = dt.datetime.now().replace(microsecond=0)
    data = [(now, j, d, s, None if dur is None else float(dur), m) for j, d, s, dur, m in rows]
    df = spark.createDataFrame(data, RUN_LOG_SCHEMA)
    df = (df.withColumn("msg", F.regexp_replace(F.col("msg"), r"[\r\n]+", " "))
          .withColumn("duration", F.round("duration", 2)))
    df.write.mode("append").parquet(path)
    return df
