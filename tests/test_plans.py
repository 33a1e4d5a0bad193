"""Plans: pruned scans, pushed filters, no single-task work on large inputs."""

from __future__ import annotations

from dataclasses import replace

import pytest

from cargolens.plans import analyses
from cargolens.registry import queries as registry
from cargolens.workspace import Workspace

FOLDER = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return registry.star(spark, FOLDER)


def test_period_reaches_the_fact_scan(star):
    plan = physical(analyses.monthly_coverage(star, (2000, 8), (2001, 12)))
    assert "GreaterThanOrEqual(order_date_key,20000800)" in plan
    assert "LessThanOrEqual(order_date_key,20011299)" in plan


def test_scans_read_only_the_needed_columns(star):
    plan = physical(analyses.loss_summary(star))
    assert "ReadSchema: struct<sales:decimal(12,2),order_profit_per_order:decimal(12,2)>" in plan
    banded = physical(analyses.discount_margin(star))
    assert "customer_key" not in banded


def test_small_dimensions_are_broadcast(star):
    for report in (analyses.delivery_outcomes, analyses.category_losses, analyses.service_by_customer_value):
        assert "SortMergeJoin" not in physical(report(star))


class Recording(Workspace):
    """Keeps the plans of what reports write before they return."""

    def materialize(self, df, name):
        self.plans = [*getattr(self, "plans", []), physical(df)]
        return super().materialize(df, name)


@pytest.fixture
def plans(star, spark, tmp_path):
    """All plans of a report: of its written parts and of its result."""

    def of(report) -> list[str]:
        recording = Recording(spark, str(tmp_path / "recording"))
        result = report(replace(star, workspace=recording))
        return [*getattr(recording, "plans", []), physical(result)]

    return of


REPORTS = {
    analyses.executive_kpis: 1, analyses.monthly_coverage: 1, analyses.loss_summary: 1,
    analyses.category_losses: 1, analyses.worst_products: 1, analyses.loss_concentration: 1,
    analyses.discount_margin: 1, analyses.discount_loss_rate: 1, analyses.delivery_outcomes: 1,
    analyses.shipping_mode_performance: 1, analyses.delay_severity: 1,
    analyses.customer_concentration: 1, analyses.service_by_customer_value: 1,
}


@pytest.mark.parametrize("report, scans", REPORTS.items(), ids=lambda x: getattr(x, "__name__", str(x)))
def test_all_work_of_a_report(plans, report, scans):
    found = plans(report)
    for plan in found:
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        assert "Python" not in plan and "Pandas" not in plan
    assert sum(plan.count("fact_order_item") for plan in found) == scans


def test_a_second_scan_or_a_cross_join_would_be_seen(plans):
    def twice(star):
        rows = star.fact.select("order_id").unionByName(star.fact.select("order_id"))
        return star.workspace.materialize(rows, "twice")

    def crossed(star):
        return star.workspace.materialize(star.product.select("product_key").crossJoin(star.date.select("year")), "x")

    assert sum(plan.count("fact_order_item") for plan in plans(twice)) == 2
    assert any("CartesianProduct" in p or "NestedLoopJoin" in p for p in plans(crossed))


def test_every_query_has_its_sql(spark):
    from cargolens.registry.oracle import oracle_sql

    assert set(registry.queries()) == set(oracle_sql())


def test_layers_are_built_once_per_input(spark):
    first = registry._warehouse(spark, FOLDER, "bronze")
    assert registry._warehouse(spark, FOLDER, "bronze") is first
    assert registry._fingerprint(spark, FOLDER) != registry._fingerprint(spark, "/root/testdata/sf0.01")


def test_samples_and_top_lists_are_not_full_sorts(star):
    from cargolens.plans.star import star_sample

    assert "TakeOrderedAndProject" in physical(star_sample(star))
    assert "TakeOrderedAndProject" in physical(analyses.worst_products(star))


def test_rankings_exchange_rows_once(spark, star, plans):
    """Of a table, and of the summaries that reports rank once these are written."""
    folder = FOLDER
    for name in ("p06_global_cumulative", "p07_global_ntile"):
        assert physical(registry.queries()[name](spark, folder)).count("Exchange") == 1
    for report in (analyses.loss_concentration, analyses.customer_concentration):
        *_, result = plans(report)
        assert result.count("Exchange") == 1 and "rangepartitioning" not in result
