"""The star schema as one lazily-built bundle, plus materialisation."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .. import params
from ..session import scratch_path
from ..sources import fixtures
from .dims import channel_dimension, date_dimension_for
from .facts import FACT_COLUMNS, message_fact
from .staging import stage_messages


def run_concurrently(*actions):
    """Run independent Spark actions (e.g. writes of unrelated tables) as concurrent jobs
    from driver threads; returns their results in order. Spark schedules their tasks side by
    side, which fills cores left idle by small or single-task stages."""
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]


@dataclass
class Warehouse:
    """stg -> dim_dates, dim_channels -> fct, all lazy DataFrames sharing one as-of instant."""

    raw: DataFrame
    as_of: object = None
    pad_days: int = params.CALENDAR_PAD_DAYS
    # write the two (aggregated, small) dimensions to the shared checkpoint folder on first use
    # and read them back: joins then see their real size (broadcast only if small, sort-merge
    # otherwise) and their lineage is cut; staging and the fact stay lazy
    stage_dimensions: bool = False
    _cache: dict = field(default_factory=dict, repr=False)

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def spark(self) -> SparkSession:
        return self.raw.sparkSession

    @property
    def stg(self) -> DataFrame:
        return self._get("stg", lambda: stage_messages(self.raw, self.as_of))

    def _dims(self) -> None:
        if "dim_dates" in self._cache and "dim_channels" in self._cache:
            return
        dates = date_dimension_for(self.stg, self.pad_days, self.as_of)
        channels = channel_dimension(self.stg, self.as_of)
        if self.stage_dimensions:
            base = scratch_path(self.spark, "dimensions")

            def written(df: DataFrame, name: str) -> DataFrame:
                df.write.mode("overwrite").parquet(f"{base}/{name}")
                return self.spark.read.parquet(f"{base}/{name}")

            dates, channels = run_concurrently(lambda: written(dates, "dim_dates"),
                                               lambda: written(channels, "dim_channels"))
        self._cache.setdefault("dim_dates", dates)
        self._cache.setdefault("dim_channels", channels)

    @property
    def dim_dates(self) -> DataFrame:
        self._dims()
        return self._cache["dim_dates"]

    @property
    def dim_channels(self) -> DataFrame:
        self._dims()
        return self._cache["dim_channels"]

    @property
    def fct(self) -> DataFrame:
        return self._get("fct", lambda: message_fact(self.stg, self.dim_channels, self.dim_dates))

    def tables(self) -> dict[str, DataFrame]:
        return {"stg_messages": self.stg, "dim_dates": self.dim_dates,
                "dim_channels": self.dim_channels, "fct_messages": self.fct}

    def materialize(self, path: str, fmt: str = "parquet", partition_fact_by: str | None = None,
                    calendar: DataFrame | None = None) -> "Warehouse":
        """Build the tables in dependency order, each from the *written* tables before it:
        staging is written once and read back, the dimensions are built from it, the fact from
        staging and dimensions. Every write is an overwrite (a rerun rebuilds), and reading
        back cuts the lineage, so a lost executor only recomputes from the last table.
        ``partition_fact_by`` (e.g. ``date_key``) lets date-bounded reports prune files;
        ``calendar`` replaces the data-derived calendar (e.g. a declared date range)."""
        base = path.rstrip("/")

        def write(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
            if by:
                # rebalance on the partition column: AQE coalesces small outputs into fewer files
                # per folder and splits a hot value (one day with a third of the rows) across tasks
                df = df.hint("rebalance", by)
            w = df.write.mode("overwrite").format(fmt)
            if by:
                w = w.partitionBy(by)
            w.save(f"{base}/{name}")
            return self.spark.read.format(fmt).load(f"{base}/{name}")

        stg = write(stage_messages(self.raw, self.as_of), "stg_messages")
        # the two dimensions only depend on staging: build them as concurrent jobs
        dates, channels = run_concurrently(
            lambda: write(calendar if calendar is not None else date_dimension_for(stg, self.pad_days, self.as_of),
                          "dim_dates"),
            lambda: write(channel_dimension(stg, self.as_of), "dim_channels"))
        fct = write(message_fact(stg, channels, dates), "fct_messages", partition_fact_by)
        if partition_fact_by:
            fct = fct.select(*[c for c in FACT_COLUMNS])
        w = Warehouse(self.raw, self.as_of, self.pad_days)
        w._cache.update({"stg": stg, "dim_dates": dates, "dim_channels": channels, "fct": fct})
        return w

    def register(self) -> None:
        """Expose the tables as temp views for SQL users."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def fixture_warehouse(spark: SparkSession, sf_dir: str, as_of=params.DEFAULT_AS_OF,
                      stage_dimensions: bool = False) -> Warehouse:
    return Warehouse(fixtures.raw_messages(spark, sf_dir), as_of, stage_dimensions=stage_dimensions)
