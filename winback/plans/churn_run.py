"""The whole run: load, label, features, split, train, compare, explain, list, export."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from winback.operators import charts
from winback.operators.evaluate import churn_probability, evaluate_predictions, stack_predictions
from winback.operators.features import features_of, labels_of, people_table, state_summary
from winback.operators.labels import DEFAULT_THRESHOLD_DAYS, PERSON, churn_rate_report
from winback.operators.importance import feature_influence
from winback.operators.leads import high_risk, ranked, top_leads
from winback.operators.models import checked_names, train_baseline_models
from winback.operators.prepare import ModelInput, row_counts, split_and_scale
from winback.operators.reuse import checkpointed
from winback.sources.schemas import ShopTables
from winback.sources.sinks import write_leads

RUN_THRESHOLD = 0.60


@dataclass(frozen=True)
class ChurnRun:
    """Everything one run produces; the frames are lazy, training is done."""

    labels: DataFrame
    churn_report: DataFrame
    features: DataFrame
    counts: DataFrame
    model_input: ModelInput
    models: dict[str, PipelineModel]
    comparison: DataFrame
    coefficients: DataFrame
    scored: DataFrame
    leads: DataFrame

    @property
    def top_leads(self) -> DataFrame:
        return top_leads(self.leads)

    @property
    def top_risk_factors(self) -> DataFrame:
        return charts.top_risk_factors(self.coefficients)

    @property
    def coefficient_chart(self) -> DataFrame:
        return charts.coefficient_chart(self.coefficients, top_n=10)

    @property
    def probability_stats(self) -> DataFrame:
        return charts.probability_stats(self.scored)

    @property
    def probability_chart(self) -> DataFrame:
        return charts.probability_chart(self.scored)

    def roc_chart(self, score_steps: int | None = None) -> DataFrame:
        return charts.roc_curve_table(self.models, self.model_input.test, score_steps)


def run_churn(
    tables: ShopTables,
    threshold_days: int = DEFAULT_THRESHOLD_DAYS,
    test_size: float = 0.2,
    threshold: float = RUN_THRESHOLD,
    champion_name: str | None = None,
    model_names: list[str] | None = None,
    as_of: dt.datetime | None = None,
    leads_path: str | None = None,
    leads_format: str = "csv",
) -> ChurnRun:
    """Run every step on the given tables and, with a path, export the lead list.

    The lead list is made from the test part, as the stand-in for today's customers. Names of models are checked before any
    work is done; ``coefficients`` are those of a linear champion, of any other its permutation importance on the test part.
    """
    names, best_name = checked_names(model_names, champion_name)
    people = people_table(tables, as_of)
    summary = state_summary(people)
    labels = labels_of(people, summary, threshold_days).select(PERSON, "last_order_date", "recency", "is_churn")
    features = checkpointed(features_of(people, summary, threshold_days))
    model_input = split_and_scale(features, test_size=test_size)
    models = train_baseline_models(model_input.train, names=names)
    comparison = evaluate_predictions(stack_predictions(models, model_input.test))
    best = models[best_name]
    scored = checkpointed(churn_probability(best, model_input.test))
    leads = ranked(high_risk(scored, threshold))
    coefficients = feature_influence(best, model_input.test)
    if leads_path:
        write_leads(leads, leads_path, leads_format)
    return ChurnRun(
        labels=labels,
        churn_report=churn_rate_report(labels),
        features=features,
        counts=row_counts(features),
        model_input=model_input,
        models=models,
        comparison=comparison,
        coefficients=coefficients,
        scored=scored,
        leads=leads,
    )
