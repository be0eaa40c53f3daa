"""Composed loads: daily merge, full reload, fallback, all objects, the demo script.

Every step is a Spark job over files: landed pages are read in parallel, the
CSV stage is written by every task, the typed day is written once as Parquet
(it cuts the lineage before the merge, so a lost executor recomputes from
the stage, not from the pages), and the merged table goes to a new version.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import c
from ..operators.merge import assert_unique_keys, merge_upsert
from ..schemas import DEMO_COLUMNS, DEMO_LITERAL_ROWS, DEMO_PARAMS, ObjectSpec
from ..sources.literal import literal_source
from ..sources.pages import daily_source, full_source
from ..sources.stage import stage_and_load, stage_path
from .buckets import publish_bucketed
from .partitions import partition_value, publish_partitioned, upsert_partitions
from .tables import as_nullable, load_like, publish, same_shape, script_commit, script_publish, table_like, version_path

try:  # errors raised from the JVM that are not mapped to a Python class
    from py4j.protocol import Py4JJavaError
except ImportError:  # pragma: no cover
    Py4JJavaError = PySparkException  # type: ignore[misc,assignment]

LOAD_ERRORS = (PySparkException, Py4JJavaError, ValueError)


@dataclass(frozen=True)
class LoadPaths:
    """Where one run reads and writes, all under shared storage.

    ``landing/<object>/full/ds=<day>`` holds the full extract taken by the run
    of that day, ``landing/<object>/ds=<day>`` the day's pages; stages and
    table versions go to their own roots.
    """

    landing: str
    stage: str
    tables: str

    def landing_full(self, obj: str, ds: str) -> str:
        return f"{self.landing}/{obj}/full/ds={ds}"

    def landing_day(self, obj: str, ds: str) -> str:
        return f"{self.landing}/{obj}/ds={ds}"

    def table_root(self, name: str) -> str:
        return f"{self.tables}/{name}"


@dataclass
class LoadResult:
    table: str
    branch: str  # "daily" or "full"
    error: str | None = None
    rows: int | None = None  # rows the branch loaded
    longest: dict[str, int] | None = None  # longest value of every column with a length rule


class Seen:
    """Counts taken while rows are written: no second pass over them.

    ``rows``, and for each column with a length rule its longest value (one
    beyond the rule fails the load in the same pass).
    """

    def __init__(self, spec: ObjectSpec):
        self.limited = [col.name for col in spec.columns if col.max_len is not None]
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        longest = [F.max(F.char_length(c(n))).alias(f"longest_{i}") for i, n in enumerate(self.limited)]
        return df.observe(self.observation, F.count(F.lit(1)).alias("rows"), *longest)

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]

    @property
    def longest(self) -> dict[str, int]:
        return {n: self.observation.get[f"longest_{i}"] or 0 for i, n in enumerate(self.limited)}


def incremental_load(spark: SparkSession, spec: ObjectSpec, ds: str, paths: LoadPaths, table: str,
                     zone: str = "UTC") -> LoadResult:
    """Merge one day's records into ``table`` (fails if the table is missing)."""
    schema = table_like(spark, table)  # missing target -> TABLE_OR_VIEW_NOT_FOUND
    if not same_shape(schema, spec.stored_schema()):
        raise ValueError(f"{table} schema differs from the {spec.name} contract")
    wire = daily_source(spark, spec, paths.landing_day(spec.name, ds), ds, zone)
    typed = stage_and_load(spark, wire, spec, stage_path(paths.stage, spec.name, ds))
    seen = apply_day(spark, spec, load_like(typed, spec.table_schema()), paths, table)
    return LoadResult(table, "daily", rows=seen.rows, longest=seen.longest)


def with_partition_column(df: DataFrame, spec: ObjectSpec) -> DataFrame:
    if not spec.partition:
        return df
    name, source, pattern = spec.partition
    return df.withColumn(name, partition_value(c(source), pattern))


def publish_spec(spark: SparkSession, spec: ObjectSpec, df: DataFrame, table: str, root: str,
                 merged: bool = False, mark: str = "") -> None:
    """Publish all rows: one version folder, partitioned or bucketed if the spec says so.

    ``merged``: ``df`` is a merge over the bucketed table, already partitioned
    by bucket, so it is written without another shuffle.
    """
    if spec.partition and spec.buckets:
        raise ValueError(f"{spec.name}: choose a partition or buckets, not both")
    if spec.partition:
        publish_partitioned(spark, with_partition_column(df, spec), table, root, spec.partition[0], mark)
    elif spec.buckets:
        publish_bucketed(spark, df, table, root, spec.key, spec.buckets, cluster=not merged, mark=mark)
    else:
        publish(spark, df, table, root, mark)


def apply_day(spark: SparkSession, spec: ObjectSpec, typed_day: DataFrame, paths: LoadPaths, table: str,
              create_if_missing: bool = False, mark: str = "") -> Seen:
    """Materialise the typed day, check its keys, merge it into ``table``, publish.

    Writing the day once as Parquet runs the casts and checks a single time
    and cuts the lineage: the merge below re-reads files on shared storage,
    not the pages and stage behind them. ``mark`` names the merge in the new
    version's folder, so that it can be told that it was done (``version_path``).
    """
    day_path = version_path(paths.table_root(f"{table}_daily"))
    seen = Seen(spec)
    keyed = with_partition_column(seen.watch(typed_day), spec)
    keyed.write.mode("errorifexists").parquet(day_path)
    day = spark.read.schema(as_nullable(keyed.schema)).parquet(day_path)
    assert_unique_keys(day, spec.key)
    day_rows = seen.rows  # sizes the filter of the day's keys
    root = paths.table_root(table)
    if create_if_missing and not spark.catalog.tableExists(table):
        if spec.partition:
            publish_partitioned(spark, day, table, root, spec.partition[0], mark)
        else:
            publish_spec(spark, spec, day, table, root, mark=mark)
        return seen
    if spec.partition:
        upsert_partitions(spark, table, day, spec.key, spec.partition[0], root, day_rows=day_rows, mark=mark)
        return seen
    merged = merge_upsert(spark.table(table), day, spec.key, check_unique=False, day_rows=day_rows)
    publish_spec(spark, spec, merged, table, root, merged=True, mark=mark)
    return seen


def full_load(spark: SparkSession, spec: ObjectSpec, ds: str, paths: LoadPaths, table: str,
              since: str = "1970-01-01") -> LoadResult:
    """Reload ``table`` from the full extract that the run of ``ds`` took (creates or resets it).

    Without that extract the load fails and the table stays as it is: an older
    one would take back the days merged since.
    """
    wire = full_source(spark, spec, paths.landing_full(spec.name, ds), since)
    typed = stage_and_load(spark, wire, spec, stage_path(paths.stage, spec.name))
    seen = Seen(spec)
    publish_spec(spark, spec, seen.watch(typed), table, paths.table_root(table))
    return LoadResult(table, "full", rows=seen.rows, longest=seen.longest)


def load_with_fallback(spark: SparkSession, spec: ObjectSpec, ds: str, paths: LoadPaths, table: str,
                       zone: str = "UTC", given_up: Callable[[], bool] = lambda: False) -> LoadResult:
    """Daily merge; on any load failure, a full reload from the same run's extract. The error text is kept.

    A load that was ``given_up`` does not start the reload.
    """
    try:
        return incremental_load(spark, spec, ds, paths, table, zone)
    except LOAD_ERRORS as e:
        if given_up():
            raise
        res = full_load(spark, spec, ds, paths, table)
        res.error = f"{type(e).__name__}: {str(e).splitlines()[0][:500]}"
        return res


class ObjectLoads:
    """The fallback loads of several objects, running side by side; one's failure or end does not stop the others.

    At most ``parallel`` run at a time, each in a thread of its own that takes over the caller's
    job properties. An object's Spark jobs carry its tag (``tag(name)``, unique to
    the run), a description, and a scheduler pool named after it (used when
    the cluster runs the FAIR scheduler, so one big object cannot hold every
    executor).
    """

    def __init__(self, spark: SparkSession, specs: list[ObjectSpec], ds: str, paths: LoadPaths,
                 table_of=lambda spec: spec.name, parallel: int = 3):
        self.spark, self.run = spark, uuid.uuid4().hex[:8]
        self.results: dict[str, LoadResult] = {}
        self._gone = {spec.name: threading.Event() for spec in specs}
        self._free = threading.Semaphore(max(1, parallel))
        self._threads = {
            spec.name: InheritableThread(target=self._load, args=(spec, ds, paths, table_of(spec)), session=spark) for spec in specs
        }
        for thread in self._threads.values():
            thread.start()

    def tag(self, name: str) -> str:
        return f"load-{self.run}-{name}"

    def _load(self, spec: ObjectSpec, ds: str, paths: LoadPaths, table: str) -> None:
        sc, gone = self.spark.sparkContext, self._gone[spec.name]
        with self._free:
            if gone.is_set():
                self.results[spec.name] = LoadResult(table, "cancelled")
                return
            sc.addJobTag(self.tag(spec.name))
            sc.setLocalProperty("spark.scheduler.pool", f"load-{spec.name}")
            sc.setJobDescription(f"load {spec.name} for {ds}")
            try:
                self.results[spec.name] = load_with_fallback(self.spark, spec, ds, paths, table, given_up=gone.is_set)
            except Exception as e:  # noqa: BLE001 - a thread's error becomes its object's result
                self.results[spec.name] = LoadResult(table, "cancelled" if gone.is_set() else "failed", f"{type(e).__name__}: {e}")

    def cancel(self, name: str) -> LoadResult:
        """End one object's load: its running jobs, those it would still start, and its fallback. A table is switched as a whole or not at all."""
        self._gone[name].set()
        while self._threads[name].is_alive():
            self.spark.sparkContext.cancelJobsWithTag(self.tag(name))
            self._threads[name].join(0.1)
        return self.results[name]

    def wait(self) -> dict[str, LoadResult]:
        """Every object's result."""
        for thread in self._threads.values():
            thread.join()
        return {name: self.results[name] for name in self._threads}


def load_all_objects(spark: SparkSession, specs: list[ObjectSpec], ds: str, paths: LoadPaths,
                     table_of=lambda spec: spec.name, parallel: int = 3) -> dict[str, LoadResult]:
    """The same fallback load for each object; objects are independent (``ObjectLoads``)."""
    return ObjectLoads(spark, specs, ds, paths, table_of, parallel).wait()


def demo_statements(ds: str, params: dict | None = None, extra: list[tuple[str, dict]] | None = None):
    """The demo script: the literal rows (frame ``demo_rows``) and one row of bound values."""
    params = params or DEMO_PARAMS
    stmts = [("SELECT * FROM {demo_rows}", {})]
    stmts.append(
        (f"SELECT :value_1 AS col_1, :value_2 AS col_2, :ds AS col_3",
         {"value_1": params["value_1"], "value_2": params["value_2"], "ds": ds})
    )
    return stmts + list(extra or [])


def script_load(spark: SparkSession, ds: str, table: str, root: str, params: dict | None = None,
                extra: list[tuple[str, dict]] | None = None,
                sources: dict[str, DataFrame] | None = None) -> DataFrame:
    """Drop, create, insert literal and bound rows, commit once."""
    sources = {"demo_rows": literal_source(spark, DEMO_LITERAL_ROWS, DEMO_COLUMNS), **(sources or {})}
    script_commit(spark, demo_statements(ds, params, extra), table, root, sources)
    return spark.table(table)


#: The demo script as one text: the table dropped and made anew, literal rows, a row of bound values.
DEMO_SCRIPT = f"""
BEGIN
  DECLARE day STRING DEFAULT :ds;
  DROP TABLE IF EXISTS IDENTIFIER(:target);
  CREATE TABLE IDENTIFIER(:target) ({", ".join(f"{n} STRING" for n in DEMO_COLUMNS)}) USING parquet;
  INSERT INTO IDENTIFIER(:target) ({", ".join(DEMO_COLUMNS)})
    VALUES {", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in DEMO_LITERAL_ROWS)};
  INSERT INTO IDENTIFIER(:target) ({", ".join(DEMO_COLUMNS)}) SELECT :value_1, :value_2, day;
END
"""


def script_text_load(spark: SparkSession, text: str, ds: str, table: str, root: str, args: dict | None = None,
                     sources: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run a whole script with bound values (``:ds``, those of the demo and ``args``), commit once."""
    script_publish(spark, text, table, root, {"ds": ds, **DEMO_PARAMS, **(args or {})}, sources)
    return spark.table(table)
