"""The fields that an agreement is read for: fixed values."""

from __future__ import annotations

#: Field, kind, class, criticality.
FIELDS = [
    ("borrower.legal_name", "text", "parties", 4),
    ("guarantor.legal_name", "text", "parties", 3),
    ("holdings.legal_name", "text", "parties", 3),
    ("administrative_agent.legal_name", "text", "parties", 4),
    ("collateral_agent.legal_name", "text", "parties", 2),
    ("arranger.legal_name", "text", "parties", 2),
    ("syndication_agent.legal_name", "text", "parties", 2),
    ("closing_date", "date", "dates", 5),
    ("initial_term_loan.maturity_date", "date", "dates", 5),
    ("revolver.maturity_date", "date", "dates", 5),
    ("initial_term_loan.commitment", "money", "economic_terms", 5),
    ("delayed_draw.commitment", "money", "economic_terms", 4),
    ("revolver.commitment", "money", "economic_terms", 5),
    ("lc_sublimit", "money", "economic_terms", 3),
    ("libor_floor_pct", "percent", "economic_terms", 5),
    ("applicable_margin.eurodollar_top_level_pct", "percent", "economic_terms", 5),
    ("commitment_fee_pct", "percent", "economic_terms", 4),
    ("fronting_fee_pct", "percent", "economic_terms", 2),
    ("ticking_fee_pct", "percent", "economic_terms", 3),
    ("facility.feature", "text", "administrative", 2),
    ("facility.lien", "text", "economic_terms", 4),
    ("facility.seniority", "text", "economic_terms", 4),
    ("facility.governing_law", "text", "administrative", 2),
    ("facility.multi_currency", "bool", "economic_terms", 3),
    ("facility.evergreen_option", "bool", "economic_terms", 3),
    ("delayed_draw.must_draw_by_date", "date", "dates", 4),
    ("delayed_draw.refusal_allowed", "bool", "economic_terms", 3),
    ("accrual.credit_spread_adjustment_pct", "percent", "economic_terms", 5),
    ("accrual.cap_pct", "percent", "economic_terms", 4),
    ("pik.rate_pct", "percent", "economic_terms", 5),
    ("pik.spread_pct", "percent", "economic_terms", 5),
    ("rating.value", "text", "economic_terms", 3),
    ("rating.agency", "text", "parties", 2),
    ("rating.credit_quality", "text", "economic_terms", 3),
    ("borrower.industry_classification", "text", "administrative", 1),
    ("amortization.quarterly_amount", "money", "economic_terms", 5),
    ("excess_cash_flow.sweep_pct", "percent", "economic_terms", 4),
    ("financial_covenant.opening_level", "ratio", "covenant_levels", 5),
    ("financial_covenant.level", "ratio", "covenant_levels", 5),
    ("financial_covenant.final_level", "ratio", "covenant_levels", 5),
    ("opening_total_leverage_ratio", "ratio", "covenant_levels", 5),
    ("indebtedness.purchase_money_basket_amount", "money", "baskets", 3),
    ("indebtedness.purchase_money_basket_ebitda_pct", "percent", "baskets", 3),
    ("incremental.free_and_clear_amount", "money", "baskets", 4),
    ("incremental.leverage_based_test", "ratio", "baskets", 4),
    ("mfn_threshold_pct", "percent", "economic_terms", 5),
    ("mfn_sunset", "text", "economic_terms", 5),
    ("consolidated_ebitda.addback_cap_pct", "percent", "covenant_levels", 5),
    ("consolidated_ebitda.addback_cap_clause_a_xvi", "percent", "covenant_levels", 5),
    ("borrowing_base.advance_rate_accounts", "percent", "economic_terms", 5),
    ("borrowing_base.advance_rate_inventory", "percent", "economic_terms", 5),
    ("borrowing_base.availability_block", "money", "economic_terms", 4),
    ("arr.leverage_covenant_level", "ratio", "covenant_levels", 5),
    ("arr.minimum_liquidity", "money", "covenant_levels", 5),
    ("nav.loan_to_value_cap", "percent", "covenant_levels", 5),
    ("pik.toggle_step_up_pct", "percent", "economic_terms", 5),
]

#: Defined terms that carry a field's value, in the order in which they are tried.
ANCHORS = {
    "closing_date": ["Closing Date"],
    "initial_term_loan.maturity_date": ["Initial Term Loan Maturity Date"],
    "revolver.maturity_date": ["Revolving Credit Maturity Date"],
    "initial_term_loan.commitment": ["Initial Term Loan Commitment"],
    "delayed_draw.commitment": ["Delayed Draw Term Loan Commitment"],
    "revolver.commitment": ["Revolving Credit Commitment"],
    "libor_floor_pct": ["Floor", "SOFR Floor", "LIBO Rate"],
    "applicable_margin.eurodollar_top_level_pct": ["Applicable Margin"],
    "accrual.credit_spread_adjustment_pct": ["Term SOFR Adjustment", "SOFR Adjustment", "Credit Spread Adjustment"],
    "pik.rate_pct": ["PIK Interest"],
    "pik.spread_pct": ["PIK Interest"],
    "financial_covenant.opening_level": ["Total Leverage Ratio"],
    "financial_covenant.level": ["Total Leverage Ratio"],
    "financial_covenant.final_level": ["Total Leverage Ratio"],
    "opening_total_leverage_ratio": ["Total Leverage Ratio"],
    "indebtedness.purchase_money_basket_ebitda_pct": ["Consolidated EBITDA"],
    "incremental.leverage_based_test": ["Senior Secured First Lien Net Leverage Ratio"],
    "mfn_threshold_pct": ["All-In Yield"],
    "consolidated_ebitda.addback_cap_pct": ["Consolidated EBITDA"],
    "consolidated_ebitda.addback_cap_clause_a_xvi": ["Consolidated EBITDA"],
    "borrowing_base.advance_rate_accounts": ["Borrowing Base"],
    "borrowing_base.advance_rate_inventory": ["Borrowing Base"],
    "arr.leverage_covenant_level": ["Annualized Recurring Revenue"],
}

KINDS = {f: k for f, k, _, _ in FIELDS}
