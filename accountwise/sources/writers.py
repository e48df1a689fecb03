"""Writing: feature matrix, predictions, warehouse layers, raw loads."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from accountwise.operators import marts, staging
from accountwise.sources.readers import BulkLoad, bulk_load_raw, schema_of
from accountwise.sources.schemas import RAW


#: Tables that are written at the same time: the tasks of one fill the cores that another's last tasks leave idle.
AT_ONCE = 4


def write_features(
    features: DataFrame, folder: str, fmt: str = "both", partition_by: str | None = None
) -> list[str]:
    """The matrix as Parquet, CSV or both. Written by all tasks; never through a single one."""
    if fmt not in ("parquet", "csv", "both"):
        raise ValueError(fmt)
    out = []
    for kind in ("parquet", "csv") if fmt == "both" else (fmt,):
        path = f"{folder}/account_features_{kind}"
        writer = features.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path) if kind == "parquet" else writer.csv(path, header=True)
        if kind == "parquet":  # the CSV copies the stored matrix instead of computing it again
            features = features.sparkSession.read.schema(features.schema).parquet(path)
        out.append(path)
    return out


PREDICTION_FOLDERS = {
    "churn_predictions": "survival/churn_risk_predictions",
    "recommendations": "cross_sell/account_recommendations",
    "probabilities": "cross_sell/cross_sell_probabilities",
    "segments": "segmentation/account_segments",
    "clv_metrics": "clv/model_comparison",
    "clv_importance": "clv/feature_importance",
    "cox_summary": "survival/cox_ph_summary",
    "cross_sell_metrics": "cross_sell/cross_sell_metrics",
    "cluster_metrics": "segmentation/cluster_metrics",
}


def write_predictions(frames: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    paths = {name: f"{folder}/{PREDICTION_FOLDERS[name]}" for name in frames}
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(lambda name: frames[name].write.mode("overwrite").parquet(paths[name]), frames))
    return paths


def load_raw_layer(spark: SparkSession, files: Mapping[str, str], folder: str) -> DataFrame:
    """Truncate-and-load every CSV into the raw layer and its quarantine; returns one count row per table.

    A file that does not exist is skipped and has no row.
    """
    summary = None
    for name, path in files.items():
        try:
            load: BulkLoad = bulk_load_raw(spark, path, schema_of(RAW[name]))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        target = f"{folder}/raw/{name}.parquet"
        written = Observation(name)
        load.good.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target)
        load.rejected.write.mode("overwrite").parquet(f"{folder}/quarantine/{name}.parquet")
        row = load.counts.select(
            F.lit(name).alias("table_name"), "loaded", "rejected", (F.col("loaded") == written.get["rows"]).alias("verified")
        )
        summary = row if summary is None else summary.unionByName(row)
    if summary is None:
        raise FileNotFoundError(f"none of {sorted(files.values())} exists")
    return summary


@dataclass(frozen=True)
class Layer:
    """A table of the warehouse: what it is made of (raw tables or layers before it), and how."""

    needs: tuple[str, ...]
    build: Callable[..., DataFrame]


PREDICTED = ("churn_predictions", "recommendations")


def layer_graph(as_of: date) -> dict[str, Layer]:
    """All layers, each after what it needs."""
    return {
        "stg_accounts": Layer(("accounts",), lambda t: staging.stg_corporate_accounts(t, as_of)),
        "stg_travelers": Layer(("travelers",), staging.stg_traveler_profiles),
        "stg_bookings": Layer(("bookings", "stg_travelers"), staging.stg_bookings),
        "stg_contracts": Layer(("contracts",), staging.stg_service_contracts),
        "stg_tickets": Layer(("tickets",), staging.stg_support_tickets),
        "stg_churn_predictions": Layer(("churn_predictions",), lambda t: staging.stg_churn_predictions(t, as_of)),
        "stg_recommendations": Layer(("recommendations",), lambda t: staging.stg_cross_sell_recommendations(t, as_of)),
        "dim_accounts": Layer(("stg_accounts",), marts.dim_accounts),
        "dim_travelers": Layer(("stg_travelers",), marts.dim_travelers),
        "dim_date": Layer(("stg_accounts",), lambda t: marts.dim_date(t.sparkSession)),
        "dim_products": Layer(("stg_contracts", "stg_recommendations"), marts.dim_products),
        "fact_bookings": Layer(("stg_bookings",), marts.fact_bookings),
        "fact_service_contracts": Layer(("stg_contracts",), marts.fact_service_contracts),
        "fact_support_tickets": Layer(("stg_tickets",), marts.fact_support_tickets),
        "mart_clv_analytics": Layer(("stg_accounts", "stg_bookings", "stg_tickets", "stg_contracts"), marts.mart_clv_analytics),
        "fact_ml_churn": Layer(("stg_churn_predictions", "dim_accounts", "stg_contracts", "stg_tickets"), marts.fact_ml_churn),
        "fact_ml_cross_sell": Layer(("stg_recommendations", "dim_accounts", "stg_contracts"), marts.fact_ml_cross_sell),
    }


def build_layers(
    tables: Mapping[str, DataFrame], as_of: date, without_predictions: bool = False,
    store: Callable[[str, DataFrame], DataFrame] = lambda name, df: df, at_once: int = 1,
) -> dict[str, DataFrame]:
    """Every layer of the graph, in order. ``store`` says what readers of a layer get: the layer itself, or what was stored.
    ``at_once`` layers are built and stored at the same time, each once what it needs is there.

    Missing prediction tables are an error, unless layers ``without_predictions`` are asked for; then those that rest on
    them are left out, and products come from contracts alone.
    """
    missing = sorted(set(PREDICTED) - set(tables))
    if missing and not without_predictions:
        raise ValueError(f"no table of {', '.join(missing)}: publish predictions, or ask for marts without them")
    graph: dict[str, tuple[Layer, tuple[str, ...]]] = {}
    for name, layer in layer_graph(as_of).items():
        lacking = {need for need in layer.needs if need not in graph and need not in tables}
        if lacking:
            if not lacking <= {*missing, "stg_churn_predictions", "stg_recommendations"}:
                raise ValueError(f"{name} needs {', '.join(sorted(lacking))}")
            if name != "dim_products":
                continue
        graph[name] = layer, tuple(lacking)
    out: dict[str, Future] = {}

    def made(name: str) -> DataFrame:
        layer, lacking = graph[name]
        have = [None if n in lacking else out[n].result() if n in graph else tables[n] for n in layer.needs]
        return store(name, layer.build(*have))

    with ThreadPoolExecutor(at_once) as pool:  # a layer waits for earlier ones only, and those were started before it
        for name in graph:
            out[name] = pool.submit(made, name)
        return {name: layer.result() for name, layer in out.items()}


def write_layers(
    tables: Mapping[str, DataFrame], as_of: date, folder: str, without_predictions: bool = False
) -> dict[str, DataFrame]:
    """Stores every layer once and hands the stored table to its readers, so each raw table is scanned once.

    Bookings are stored by month, so that date ranges prune files. The rebalance hint lets Spark split a
    heavy month over several files and merge light ones.
    """

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder}/{'staging' if name.startswith('stg_') else 'marts'}/{name}"
        if name == "fact_bookings":
            df.withColumn("booking_month", F.trunc("booking_date", "month")).hint(
                "rebalance", F.col("booking_month")
            ).write.mode("overwrite").partitionBy("booking_month").parquet(path)
            return df.sparkSession.read.parquet(path)
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return build_layers(tables, as_of, without_predictions, store, AT_ONCE)


PAGE_KEYS = ("tier", "segment")


#: Rows of a file of pages, unless a range is larger.
ROWS_PER_FILE = 100_000


def write_pages(rows: DataFrame, path: str, rows_per_range: int = 100_000, key: str = "account_id") -> str:
    """A table in ranges of its key, and an index of the ranges: page_file, page_range, tier, segment, first, last, n.

    A file, in a folder of its own, is written by one task and holds as many ranges as ``ROWS_PER_FILE`` asks for, so that tasks and
    folders do not grow with the number of ranges. ``lookups.page_after`` reads the one or two files that hold a page, however
    deep it lies, and of them the ranges it needs.
    """
    files = max(1, -(-rows.count() // max(ROWS_PER_FILE, rows_per_range)))
    ordered = rows.repartitionByRange(files, key).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id())
    # the id counts the rows of a task from its number times 2^33
    file, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    ordered = ordered.withColumns({
        "page_file": file.cast("int"), "page_range": F.shiftleft(file, 33) + F.floor(place / rows_per_range),
    }).drop("_at")
    ordered.write.mode("overwrite").partitionBy("page_file").parquet(f"{path}/rows")
    stored = rows.sparkSession.read.parquet(f"{path}/rows")
    stored.groupBy("page_file", "page_range", *PAGE_KEYS).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n")
    ).write.mode("overwrite").parquet(f"{path}/index")
    return path


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Store a table bucketed and sorted by a join key: later joins on it need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
