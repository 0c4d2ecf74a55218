"""Run everything once: ``spark-submit -m winback`` or ``python -m winback DATA --leads OUT``."""

from __future__ import annotations

import argparse

from winback import build_session, load_and_clean_data, load_tables, load_warehouse, run_churn

LOADERS = {"csv": load_and_clean_data, "parquet": load_tables, "warehouse": load_warehouse}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="winback", description="Find the customers who are about to leave.")
    parser.add_argument("data", help="folder with the shop's tables")
    parser.add_argument("--format", choices=LOADERS, default="csv")
    parser.add_argument("--leads", help="where to write the lead list")
    parser.add_argument("--leads-format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--threshold", type=float, default=0.60)
    parser.add_argument("--threshold-days", type=int, default=280)
    parser.add_argument("--models", nargs="*", help="names of the models to train; all by default")
    parser.add_argument("--champion", help="name of the model that scores the leads")
    parser.add_argument("--master", help="Spark master; leave out on a cluster")
    options = parser.parse_args(arguments)

    spark = build_session(master=options.master)
    run = run_churn(
        LOADERS[options.format](spark, options.data),
        threshold_days=options.threshold_days,
        threshold=options.threshold,
        model_names=options.models,
        champion_name=options.champion,
        leads_path=options.leads,
        leads_format=options.leads_format,
    )
    reports = {
        "Churn": run.churn_report,
        "People": run.counts,
        "Models": run.comparison,
        "Drivers": run.coefficient_chart,
        "Top risk factors": run.top_risk_factors,
        "Probabilities": run.probability_stats,
        "Top leads": run.top_leads,
    }
    for title, table in reports.items():
        print(title)
        table.show(truncate=False)


if __name__ == "__main__":
    main()
