"""Raw tables laid out for the joins and filters that read them.

Tables that meet on the contract key are bucketed and sorted by it with one number of buckets, so
that a join between them needs no exchange. A contract with more rows than a bucket should hold
would fill one task of such a join, so its rows, in every table, go to a table of their own, which
joins the ordinary way and is split by AQE. Tables that reports filter by date are partitioned by
month. Each run writes to a new folder and adds a small file that names it last, so a failed run
changes nothing, and readers of the run before still find its files.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

Raw = Callable[[str], DataFrame]

#: The contract key of the tables that meet on it, those with most rows first.
CONTRACT_KEYS = {
    "ins_oplata": "anketa_id",
    "tb_oplata": "tb_anketa",
    "ins_polis": "tb_anketa",
    "tb_polis": "tb_anketa",
    "tb_avto": "tb_anketa",
    "ins_anketa": "ins_id",
    "tb_anketa": "tb_id",
}
#: The date by which reports filter a table.
DATES = {"ins_bank_client": "pym_date", "ins_viplati": "date_viplata", "ins_rastorg": "tb_dateras"}
#: Bytes of stored files in a bucket; buckets at least and at most.
BUCKET_BYTES, LEAST, MOST = 256 << 20, 8, 65536
#: Slots of a hash in which rows are counted to find hot contracts: at least, and for each bucket.
LEAST_SLOTS, SLOTS_A_BUCKET = 1 << 16, 64
MONTH = "_month"
POINTER, RUN = "_published-", "run="


# ---- runs --------------------------------------------------------------------


def _file(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def publish(spark: SparkSession, root: str, content: dict) -> None:
    """Let readers of a folder go to a run: its pointer file appears whole or not at all."""
    store, final = _file(spark, f"{root}/{POINTER}{content['run']}")
    _, unseen = _file(spark, f"{root}/_{uuid.uuid4().hex}")
    out = store.create(unseen)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if not store.rename(unseen, final):
        raise OSError(f"could not publish {final.toString()}")


def published(spark: SparkSession, root: str) -> dict | None:
    """The content of the newest pointer; run names sort by time."""
    store, place = _file(spark, root)
    names = [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []
    newest = max((n for n in names if n.startswith(POINTER)), default=None)
    if newest is None:
        return None
    stream = store.open(_file(spark, f"{root}/{newest}")[1])
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def drop_runs(spark: SparkSession, root: str, keep: Iterable[str]) -> None:
    """Remove the runs that are not to be kept, pointers first."""
    store, place = _file(spark, root)
    names = sorted(s.getPath().getName() for s in store.listStatus(place))
    for prefix in (POINTER, RUN):
        for name in names:
            if name.startswith(prefix) and name.removeprefix(POINTER) not in keep:
                store.delete(_file(spark, f"{root}/{name}")[1], True)


def new_run() -> str:
    return f"{RUN}{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def month_of(date: Column) -> Column:
    """The month as a partition value; rows without a date share one of their own."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit("none"))


def in_months(start: dt.date, end: dt.date) -> Column:
    """The months that a half-open range of days touches."""
    last = end - dt.timedelta(days=1)
    return F.col(MONTH).between(f"{start:%Y-%m}", f"{last:%Y-%m}")


def write_months(df: DataFrame, root: str, date: str) -> None:
    """Write a table by month of a date and let readers go to it; the run before is kept."""
    spark, run, before = df.sparkSession, new_run(), published(df.sparkSession, root)
    rows = df.withColumn(MONTH, month_of(F.col(date))).hint("rebalance", F.col(MONTH))
    rows.write.partitionBy(MONTH).parquet(f"{root}/{run}")
    kept = [run] + ([before["run"]] if before else [])
    publish(spark, root, {"run": run, "date": date, "schema": df.schema.jsonValue()})
    drop_runs(spark, root, kept)


def read_months(spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """What ``write_months`` wrote last; of a range of days only the files of its months."""
    held = published(spark, root)
    schema = T.StructType.fromJson(held["schema"])
    whole = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
    rows = spark.read.schema(whole).parquet(f"{root}/{held['run']}")
    if start is not None:
        day = F.col(held["date"]).cast("date")
        rows = rows.filter(in_months(start, end) & (day >= start) & (day < end))
    return rows.select(*schema.fieldNames())


# ---- raw tables --------------------------------------------------------------


def table_bytes(df: DataFrame) -> int:
    """Size of a table's files by the planner's statistics."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bucket_count(sizes: Iterable[int]) -> int:
    """A power of two by which the largest table has buckets of at most ``BUCKET_BYTES``."""
    wanted, n = -(-max(sizes, default=0) // BUCKET_BYTES), LEAST
    while n < min(wanted, MOST):
        n *= 2
    return n


def hot_keys(tables: dict[str, DataFrame], buckets: int) -> list:
    """Keys with more rows in one table than a bucket's share; fewer than buckets a table.

    A key above the share makes a slot of a hash above it, so rows are first counted by slot, of
    which there are few to shuffle whatever the number of keys. Only the keys of slots above the
    share, fewer than buckets a table as well, are then counted one by one.
    """
    slots = max(LEAST_SLOTS, SLOTS_A_BUCKET * buckets)
    keyed, shares, full = {}, {}, []
    for name, df in tables.items():
        key = F.col(CONTRACT_KEYS[name]).cast("string").alias("key")
        slot = F.pmod(F.xxhash64(key), F.lit(slots)).cast("int").alias("slot")
        keyed[name], shares[name] = df.select(key, slot), df.agg(F.count(F.lit(1)) / buckets).scalar()
        counts = keyed[name].groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shares[name])
        full.append(counts.select(F.lit(name).alias("name"), "slot"))
    found: dict[str, list[int]] = {}
    for row in reduce(DataFrame.unionByName, full).collect():
        found.setdefault(row.name, []).append(row.slot)
    parts = []
    for name, held in found.items():
        counts = keyed[name].filter(F.col("slot").isin(held)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.filter(F.col("n") > shares[name]).select("key"))
    rows = reduce(DataFrame.unionByName, parts).collect() if parts else []
    return sorted({r.key for r in rows}, key=lambda k: (k is None, k))


def _is_hot(key: Column, hot: list) -> Column:
    named = [k for k in hot if k is not None]
    test = F.coalesce(key.cast("string").isin(named), F.lit(False)) if named else F.lit(False)
    return test | key.isNull() if None in hot else test


def stage(raw: Raw, names: Iterable[str], spark: SparkSession, root: str, buckets: int | None = None) -> "Staged":
    """Lay out the named raw tables under a root and return them; see the module for how.

    ``buckets`` follows the largest table unless it is given. Tables with neither a contract key
    nor a report date are stored as they are.
    """
    names = list(names)
    keyed = {n: raw(n) for n in CONTRACT_KEYS if n in names}
    count = buckets or bucket_count(map(table_bytes, keyed.values()))
    hot = hot_keys(keyed, count) if keyed else []
    run, before = new_run(), published(spark, root)
    held = {"run": run, "buckets": count, "hot": bool(hot), "tables": {}}
    for name in names:
        df, key, date = raw(name), CONTRACT_KEYS.get(name), DATES.get(name)
        held["tables"][name] = df.schema.jsonValue()
        path = f"{root}/{run}/{name}"
        if key:
            cold = df.filter(~_is_hot(F.col(key), hot)) if hot else df
            table = _table(root, run, name)
            cold.repartition(count, key).sortWithinPartitions(key).write.bucketBy(count, key).sortBy(key).option(
                "path", path
            ).mode("overwrite").saveAsTable(table)
            if hot:
                df.filter(_is_hot(F.col(key), hot)).hint("rebalance").write.parquet(f"{path}__hot")
        elif date and date in df.columns:
            df.withColumn(MONTH, month_of(F.col(date))).hint("rebalance", F.col(MONTH)).write.partitionBy(MONTH).parquet(path)
        else:
            df.write.parquet(path)
    publish(spark, root, held)
    drop_runs(spark, root, [run] + ([before["run"]] if before else []))
    return Staged(spark, root)


def _table(root: str, run: str, name: str) -> str:
    return f"staged_{uuid.uuid5(uuid.NAMESPACE_URL, f'{root}/{run}').hex[:12]}_{name}"


class Staged:
    """Raw tables by name, as ``stage`` laid them out."""

    def __init__(self, spark: SparkSession, root: str):
        held = published(spark, root)
        if held is None:
            raise FileNotFoundError(f"nothing staged under {root}")
        self.spark, self.root, self.run = spark, root, held["run"]
        self.buckets, self.hot, self.tables = held["buckets"], held["hot"], held["tables"]

    def _schema(self, name: str):
        return T.StructType.fromJson(self.tables[name])

    def _path(self, name: str) -> str:
        return f"{self.root}/{self.run}/{name}"

    def _bucketed(self, name: str) -> DataFrame:
        """The bucketed part; a session that did not write it learns its layout first."""
        table = _table(self.root, self.run, name)
        if not self.spark.catalog.tableExists(table):
            key = CONTRACT_KEYS[name]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema(name).fields)
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                f"INTO {self.buckets} BUCKETS LOCATION '{self._path(name)}'"
            )
        return self.spark.table(table)

    def _hot(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._schema(name)).parquet(f"{self._path(name)}__hot")

    def __call__(self, name: str) -> DataFrame:
        if name in CONTRACT_KEYS:
            cold = self._bucketed(name)
            return cold.unionByName(self._hot(name)) if self.hot else cold
        rows = self.spark.read.schema(self._schema(name)).parquet(self._path(name))
        return rows.drop(MONTH) if name in DATES else rows

    def contract_parts(self) -> list[Raw]:
        """Raw tables in parts that no contract spans: bucketed ones, and those of hot contracts."""
        cold = lambda name: self._bucketed(name) if name in CONTRACT_KEYS else self(name)
        hot = lambda name: self._hot(name) if name in CONTRACT_KEYS else self(name)
        return [cold, hot] if self.hot else [cold]

    def between(self, name: str, start: dt.date, end: dt.date) -> DataFrame:
        """Rows of a range of days; only the files of its months are read."""
        schema, day = self._schema(name), F.col(DATES[name]).cast("date")
        rows = self.spark.read.schema(schema.add(MONTH, "string")).parquet(self._path(name))
        rows = rows.filter(in_months(start, end) & (day >= start) & (day < end))
        return rows.select(*[c for c in rows.columns if c != MONTH])


def by_contract(build: Callable[[Raw], DataFrame], raw: Raw) -> DataFrame:
    """Rows that are joined by contract only, built from each part of the raw tables."""
    if not isinstance(raw, Staged):
        return build(raw)
    return reduce(DataFrame.unionByName, [build(part) for part in raw.contract_parts()])


def rows_between(raw: Raw, name: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows of a raw table with its report date in a half-open range of days."""
    if isinstance(raw, Staged):
        return raw.between(name, start, end)
    day = F.col(DATES[name])
    return raw(name).filter((day >= start) & (day < end))
