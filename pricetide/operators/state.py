"""The stored state of the daily load (S7): a version costs what its batch touches.

* ``products``: products with their latest observation (columns last_...), a Parquet table
  bucketed by its key (name, store_id) and partitioned by version.  A version adds the rows
  that it changed; the newest row of a key counts.  A batch is joined to it, and the newest
  rows are found, without a shuffle of the stored side.  After ``COMPACT`` versions all
  newest rows are written once more, and older ones are no longer read.
* ``prices``: the history, partitioned by day and version.  A version writes the days in
  which a row changed, as a whole; other days stay as they are.
* ``commits``: one row per version, written last: run id, highest ids, and for each calendar
  day which version of it counts and its roll-up (rows, sum, lowest and highest price,
  newest time).  What has no commit is never read, and a version that is written again
  replaces its own files only.

So a merge reads the products, the batch's days and one commit, and no aggregate over the
history is taken: the latest observation and the highest ids are kept, not searched.  The
questions over latest rows (A3, A8, A12, A13, ...) read ``star(version).latest``, and the
headline numbers (A1) add up the days' roll-ups (``kpis``): both follow each batch.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pricetide.operators import load as L
from pricetide.operators.analytics import headline
from pricetide.session import bucket_count, checkpoint_dir
from pricetide.sources.adapters import Star

KEY = ["name", "store_id"]
SEEN = ["scraped_at", "id", "price", "currency", "availability", "price_change", "price_change_pct"]      # of a price row, newest first
LATEST = ["last_" + c for c in SEEN]
COMPACT = 16                     # versions whose changes are read together at most


@dataclass
class Merged:
    version: int
    products: DataFrame          # one row per key of the batch: id, name, store_id, action
    prices: DataFrame            # one row per product and day of the batch, with its action


class VersionedState:
    """Products and price history under ``root``; version 0 is the initial state."""

    PRODUCTS = ("id bigint, name string, brand string, url string, sku string, category_id bigint, "
                "store_id bigint, created_at timestamp_ntz")
    PRICES = ("id bigint, product_id bigint, price double, currency string, availability boolean, "
              "price_change double, price_change_pct double, scraped_at timestamp_ntz, obs_date date")
    COMMIT = ("version int, run_id bigint, first int, buckets int, max_product_id bigint, max_price_id bigint, "
              "days array<struct<obs_date: date, version: int, n: bigint, total: double, low: double, high: double, newest: timestamp_ntz>>")
    STORED = PRODUCTS + (", last_scraped_at timestamp_ntz, last_id bigint, last_price double, last_currency string, "
                         "last_availability boolean, last_price_change double, last_price_change_pct double")

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """``buckets`` (default: as the session suggests) holds for a new state."""
        self.spark, self.root = spark, root
        self.buckets = buckets or bucket_count(spark)
        self._known: dict[int, Row] = {}

    # ------------------------------------------------------------ commits

    def _exists(self, *parts: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, *parts))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def _commits(self) -> DataFrame | None:
        if not self._exists("commits"):
            return None
        return self.spark.read.schema(self.COMMIT).parquet(os.path.join(self.root, "commits", "v*"))

    def commit_of(self, version: int) -> Row:
        if version not in self._known:
            c = self._commits()
            row = None if c is None else c.where(F.col("version") == int(version)).first()
            if row is None:
                raise ValueError(f"no version {version} in {self.root}")
            self._known[version] = row
        return self._known[version]

    def latest_version(self) -> int:
        """Highest committed version (-1 when none)."""
        c = self._commits()
        row = None if c is None else c.agg(F.max("version")).first()
        return -1 if row is None or row[0] is None else int(row[0])

    def place_of(self, run_id: int) -> int:
        """The version that a run writes: the next one, or its own if it is the newest run
        and is repeated.  An older run can't be repeated, as later ones build on it."""
        c = self._commits()
        found = None if c is None else c.where((F.col("version") > 0) & (F.col("run_id") == int(run_id))).agg(F.max("version")).first()[0]
        newest = self.latest_version()
        if found is None:
            return newest + 1
        if found != newest:
            raise ValueError(f"run {run_id} is version {found}, on which version {newest} builds")
        return int(found)

    def _commit(self, version: int, run_id: int | None, first: int, max_product_id: int, max_price_id: int, days: dict) -> None:
        def one(d):
            low, high = (f"CAST({x!r} AS DOUBLE)" if x is not None else "NULL" for x in (d["low"], d["high"]))
            total = f"CAST({d['total']!r} AS DOUBLE)" if d["total"] is not None else "NULL"
            newest = f"TIMESTAMP_NTZ'{d['newest']}'" if d["newest"] is not None else "NULL"
            return (f"named_struct('obs_date', DATE'{d['obs_date']}', 'version', {int(d['version'])}, 'n', {int(d['n'])}, "
                    f"'total', {total}, 'low', {low}, 'high', {high}, 'newest', {newest})")
        live = ", ".join(one(days[d]) for d in sorted(days))
        values = [int(version), "NULL" if run_id is None else int(run_id), int(first), self.buckets, int(max_product_id), int(max_price_id), f"array({live})"]
        fields = [f.split(" ", 1) for f in self.COMMIT.split(", ", 6)]
        row = ", ".join(f"CAST({v} AS {kind}) AS {name}" for v, (name, kind) in zip(values, fields))
        self._known.pop(version, None)
        self.spark.sql(f"SELECT {row}").write.mode("overwrite").parquet(os.path.join(self.root, "commits", f"v{version:06d}"))

    # ------------------------------------------------------------ tables

    def _table(self) -> str:
        """The products as a table of this session's catalog, over the files in ``root``."""
        name = "pricetide_state_" + hashlib.md5(self.root.encode()).hexdigest()[:16]
        if not self.spark.catalog.tableExists(name):
            c = self._commits()
            if c is not None and (row := c.first()) is not None:
                self.buckets = row["buckets"]
            where = os.path.join(self.root, "products").replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {name} ({self.STORED}, version int) USING parquet PARTITIONED BY (version) "
                           f"CLUSTERED BY ({', '.join(KEY)}) INTO {self.buckets} BUCKETS LOCATION '{where}'")
            if self._exists("products"):
                self.spark.catalog.recoverPartitions(name)
        return name

    def products(self, version: int) -> DataFrame:
        """Newest row of every product: STORED."""
        c = self.commit_of(version)
        rows = self.spark.table(self._table()).where((F.col("version") >= c["first"]) & (F.col("version") <= int(version)))
        rest = [f.name for f in rows.schema.fields if f.name not in (*KEY, "version")]
        if c["first"] < version:                          # grouped by the buckets' columns: no shuffle
            rows = rows.groupBy(*KEY).agg(F.max_by(F.struct(*rest), "version").alias("r")).select(*KEY, "r.*")
        return rows.select(*L.PRODUCT_COLS, *LATEST)

    def prices(self, version: int, days: list | None = None) -> DataFrame:
        """The history as of a version, or its rows of ``days``: only their folders are listed and read."""
        live = {d["obs_date"]: d["version"] for d in self.commit_of(version)["days"]}
        return self._rows_of({d: v for d, v in live.items() if days is None or d in days})

    def read(self, version: int) -> tuple[DataFrame, DataFrame]:
        return self.products(version).select(*L.PRODUCT_COLS), self.prices(version)

    def star(self, version: int, stores: DataFrame, categories: DataFrame) -> Star:
        """The state as questions read it; the latest rows are the kept ones."""
        rows = self.products(version)
        latest = rows.where("last_id IS NOT NULL").select(
            F.col("last_id").alias("id"), F.col("id").alias("product_id"), *[F.col(f"last_{c}").alias(c) for c in L.PRICE_COLS if c in SEEN and c != "id"],
            F.to_date("last_scraped_at").alias("obs_date")).select(*L.PRICE_COLS)
        return Star(stores, categories, rows.select(*L.PRODUCT_COLS), self.prices(version), latest=latest)

    def kpis(self, version: int, stores: DataFrame, categories: DataFrame) -> DataFrame:
        """A1 from the days' roll-ups and the latest rows; the history is not read."""
        commits = self._commits().where(F.col("version") == int(version)).select(F.explode("days").alias("d")).select("d.*")
        return headline(self.star(version, stores, categories), commits.agg(
            F.sum("total").alias("total"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("newest").alias("newest")))

    # ------------------------------------------------------------ writing

    def _write_products(self, version: int, rows: DataFrame) -> None:
        fields = [f.split() for f in self.STORED.split(", ")]
        names = ", ".join(n for n, _ in fields)
        rows = rows.select(*[F.col(n).cast(kind).alias(n) for n, kind in fields]).repartition(self.buckets, *KEY)
        # the rows of a micro-batch belong to a session of their own (the catalog is shared)
        rows.sparkSession.sql(f"INSERT OVERWRITE TABLE {self._table()} PARTITION (version = {int(version)}) ({names}) "
                              f"SELECT {names} FROM {{rows}}", rows=rows)

    def _write_prices(self, version: int, rows: DataFrame) -> tuple[dict, int]:
        """Days of a version; gives their entries for the commit and the highest id.  The
        rebalance gives a large day several tasks and puts small ones together."""
        from pyspark.sql import Observation
        seen = Observation()
        (rows.hint("rebalance", F.col("obs_date")).sortWithinPartitions("obs_date", "product_id", "scraped_at")
         .observe(seen, F.collect_set("obs_date").alias("days"), F.max("id").alias("top"))        # one entry per calendar day
         .withColumn("version", F.lit(int(version))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("obs_date", "version").parquet(os.path.join(self.root, "prices")))
        written = self._rows_of({d: version for d in seen.get["days"]})
        exact = F.sum(F.col("price").cast("decimal(18,6)")).cast("double")                          # the same in any order of rows
        found = written.groupBy("obs_date").agg(F.count(F.lit(1)).alias("n"), exact.alias("total"), F.min("price").alias("low"),
                                                F.max("price").alias("high"), F.max("scraped_at").alias("newest")).collect()
        return {r["obs_date"]: {**r.asDict(), "version": version} for r in found}, seen.get["top"] or 0

    def _rows_of(self, days: dict) -> DataFrame:
        base = os.path.join(self.root, "prices")
        paths = [f"{base}/obs_date={d}/version={v}" for d, v in sorted(days.items())]
        if not paths:
            return self.spark.createDataFrame([], self.PRICES)
        return self.spark.read.schema(self.PRICES + ", version int").option("basePath", base).parquet(*paths).select(*L.PRICE_COLS)

    def write(self, version: int, products: DataFrame, prices: DataFrame, run_id: int | None = None) -> None:
        """A whole state as a version (the initial one, or one that is brought in)."""
        checkpoint_dir(self.spark)
        days, top_price = self._write_prices(version, prices.select(*L.PRICE_COLS))
        latest = (self._rows_of({d: version for d in days}).groupBy("product_id").agg(F.max(F.struct(*SEEN)).alias("l"))
                  .select("product_id", *[F.col(f"l.{c}").alias(f"last_{c}") for c in SEEN]))
        full = products.select(*L.PRODUCT_COLS).join(latest, F.col("id") == F.col("product_id"), "left").drop("product_id")
        if version > 0:                          # may come from this state: a plan can't read a table and overwrite it
            full = full.checkpoint()
        self._write_products(version, full)
        top = self.spark.table(self._table()).where(F.col("version") == int(version)).agg(F.max("id")).first()[0] or 0
        self._commit(version, run_id, version, top, top_price, days)

    def merge(self, batch: DataFrame, created_at: Column, version: int | None = None, run_id: int | None = None) -> Merged:
        """The next version: ``batch`` (cleaned rows: KEY, category_id, brand, url, sku, price,
        currency, availability, scraped_at) into version - 1.  The newest row of a key and day
        counts (ties: lowest price, then the largest of the other columns); days are loaded in
        order.  Rows without a time count as taken at ``created_at``, the time of new products."""
        version = self.latest_version() + 1 if version is None else version
        base = self.commit_of(version - 1)
        checkpoint_dir(self.spark)
        batch = batch.withColumn("scraped_at", F.coalesce("scraped_at", created_at))
        rest = sorted(c for c in batch.columns if c not in (*KEY, "scraped_at", "price"))
        order = F.struct(F.col("scraped_at"), -F.col("price"), *rest)
        day = F.to_date("scraped_at").alias("obs_date")
        daily = (batch.groupBy(*KEY, day).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in KEY]), order).alias("r"))
                 .select(*KEY, "obs_date", "r.*")).checkpoint()
        newest = daily.groupBy(*KEY).agg(F.max_by(F.struct("brand", "url", "sku", "category_id"), "obs_date").alias("r")).select(*KEY, "r.*")
        keyed = L.merge_products(self.products(version - 1), newest, created_at, base["max_product_id"], LATEST)

        inc = (daily.join(keyed.select(F.col("id").alias("product_id"), *KEY), KEY)
               .select("product_id", "price", "currency", "availability", "scraped_at"))
        batch_days = [r[0] for r in daily.select("obs_date").distinct().collect()]        # one entry per calendar day
        stored = self.prices(version - 1, batch_days)
        latest = keyed.where("last_scraped_at IS NOT NULL").select(F.col("id").alias("product_id"), F.col("last_scraped_at").alias("scraped_at"), F.col("last_price").alias("price"))
        actions = L.price_actions(stored, inc, latest).checkpoint()
        changed, n_added, top_product = actions.agg(F.collect_set(F.when(F.col("action") != "noop", F.col("obs_date"))),
                                                    F.count_if(F.col("action") == "insert"), F.max("product_id")).first()
        some = F.col("obs_date").isin(changed) if changed else F.lit(False)
        added = L.new_prices(actions, base["max_price_id"])
        written = {}
        if changed:
            written, _ = self._write_prices(version, L.updated_prices(stored.where(some), actions).unionByName(added))

        updated = actions.where("action = 'update'").withColumn("scraped_at", F.col("__old_ts")).withColumn("id", F.col("__id"))
        moved = (added.select("product_id", *SEEN).unionByName(updated.select("product_id", *SEEN))
                 .groupBy("product_id").agg(F.max(F.struct(*SEEN)).alias("l")))
        newer = F.col("l").isNotNull() & (F.col("last_scraped_at").isNull() | (F.struct("l.scraped_at", "l.id") >= F.struct("last_scraped_at", "last_id")))
        rows = (keyed.join(moved, keyed["id"] == moved["product_id"], "left").where("changed OR l IS NOT NULL")
                .select(*L.PRODUCT_COLS, *[F.when(newer, F.col(f"l.{c}")).otherwise(F.col(f"last_{c}")).alias(f"last_{c}") for c in SEEN]))
        first = base["first"]
        if version - first >= COMPACT:
            first, keep = version, self.products(version - 1)
            rows = keep.join(rows.select(*KEY), KEY, "left_anti").select(rows.columns).unionByName(rows).checkpoint()
        self._write_products(version, rows)
        days = {d["obs_date"]: d.asDict() for d in base["days"]} | written
        self._commit(version, run_id, first, max(base["max_product_id"], top_product or 0), base["max_price_id"] + n_added, days)
        return Merged(version, keyed.select("id", *KEY, "action"), actions.select(*L.ACTION_COLS))
