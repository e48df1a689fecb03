"""Command line of the batch jobs: ``spark-submit`` or ``python -m accountwise <job> ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from accountwise.config import Params
from accountwise.plans import jobs


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="accountwise")
    sub = ap.add_subparsers(dest="job", required=True)

    def job(name: str, **flags):
        p = sub.add_parser(name)
        for flag, spec in flags.items():
            p.add_argument(f"--{flag.replace('_', '-')}", **spec)

    need, day = {"required": True}, {"type": date.fromisoformat}
    data, feats = {"data_dir": need, "output_dir": need}, {"features": need, "output_dir": need}
    cutoff = {"cutoff": {**day, "default": Params().cutoff}}
    job("load-raw", **data)
    job("marts", **data, as_of={**day, "default": date.today()}, without_predictions={"action": "store_true"})
    job("publish", models=need, raw_dir=need)
    job("labels", **data, **cutoff)
    job("features", **data, **cutoff, format={"choices": ["csv", "parquet", "both"], "default": "both"},
        source={"choices": ["local", "catalog"], "default": "local"}, namespace={"default": "staging"},
        prefix={"default": ""})
    job("clv", **feats, no_tune={"action": "store_true"})
    job("survival", **feats)
    job("segments", **feats)
    job("cross-sell", **feats)
    job("check-tables", data_dir=need)
    job("check-features", features=need)
    job("manifest", **data)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"accountwise {a.job}").getOrCreate()
    params = Params(cutoff=getattr(a, "cutoff", Params().cutoff))
    run = {
        "load-raw": lambda: jobs.load_raw(spark, a.data_dir, a.output_dir),
        "marts": lambda: jobs.build_marts(spark, a.data_dir, a.output_dir, a.as_of, a.without_predictions),
        "publish": lambda: jobs.publish_predictions(spark, a.models, a.raw_dir),
        "labels": lambda: jobs.build_labels(spark, a.data_dir, a.output_dir, params),
        "features": lambda: jobs.build_features(
            spark, a.data_dir, a.output_dir, params, a.format, source=a.source, namespace=a.namespace, prefix=a.prefix),
        "clv": lambda: jobs.train_clv(spark, a.features, a.output_dir, tune=not a.no_tune),
        "survival": lambda: jobs.train_survival(spark, a.features, a.output_dir),
        "segments": lambda: jobs.segment_accounts(spark, a.features, a.output_dir),
        "cross-sell": lambda: jobs.train_cross_sell(spark, a.features, a.output_dir),
        "check-tables": lambda: jobs.check_tables(spark, a.data_dir),
        "check-features": lambda: jobs.check_features(spark, a.features),
        "manifest": lambda: jobs.write_manifest(spark, a.data_dir, a.output_dir),
    }[a.job]()
    if a.job.startswith("check"):
        run.show(100, truncate=False)
        return 0 if run.where("NOT ok").isEmpty() else 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
