"""Reconciliation identities between the KPI breakdowns (SURVEY §5 (c)),
checked on the registered queries over the smallest driver tables."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kpi(spark):
    qs = entry.queries()
    return lambda name: qs[name](spark, SF).collect()


def test_customer_breakdowns_sum_to_the_base(kpi):
    base = kpi("kpi_customers")[0]
    tiers, segments = kpi("kpi_by_tier"), kpi("kpi_by_segment")
    assert sum(r.customer_count for r in tiers) == base.total_customers
    assert sum(r.customer_count for r in segments) == base.total_customers
    assert sum(r.at_risk_count for r in tiers) == base.at_churn_risk
    assert sum(r.at_risk_count for r in kpi("kpi_churn_by_tier")) == base.at_churn_risk
    assert kpi("kpi_churn_rollup")[0].total_at_risk == base.at_churn_risk


def test_transaction_breakdowns_sum_to_the_totals(kpi):
    t = kpi("kpi_transactions")[0]
    bands = kpi("kpi_value_bands")
    assert sum(r.transaction_count for r in bands) == t.total_transactions
    assert sum(r.total_revenue for r in bands) == t.total_revenue
    months = kpi("kpi_monthly_channel")
    assert sum(r.transaction_count for r in months) == t.total_transactions
    assert sum(r.revenue for r in months) == t.total_revenue
    tiers = kpi("kpi_revenue_by_tier")                     # transactions with a tier only
    assert sum(r.transaction_count for r in tiers) <= t.total_transactions


def test_support_breakdowns_and_quarantine_reconcile(kpi):
    s = kpi("kpi_support")[0]
    assert sum(r.ticket_count for r in kpi("kpi_support_by_category")) == s.total_tickets
    assert sum(r.ticket_count for r in kpi("kpi_support_by_speed")) == s.total_tickets
    a = kpi("quarantine_audit")[0]
    assert a.input_rows == a.clean_rows + a.quarantined_rows
    assert a.quarantined_rows == a.malformed_timestamp_rows + a.missing_customer_rows
    assert sum(r.row_count for r in kpi("quarantine_summary")) == a.quarantined_rows
