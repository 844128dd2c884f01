"""The declared datasets: ``SET_A``, ``SET_B``, the monthly invoice and the daily balance."""

from __future__ import annotations

from dataclasses import replace

from tidegate.spec import LINEAGE, DatasetSpec, HistorySpec
from tidegate.specs import columns as declared
from tidegate.specs.documents import BANK_FEED, FINANCIAL_REPORT, LEDGER_PAGE

_SOURCES = {
    "accounts": (declared.ACCOUNTS, LEDGER_PAGE),
    "balance_sheet": (declared.BALANCE_SHEET, FINANCIAL_REPORT),
    "p_and_l": (declared.P_AND_L, FINANCIAL_REPORT),
    "invoice": (declared.INVOICE, LEDGER_PAGE),
    "payments": (declared.PAYMENTS, LEDGER_PAGE),
    "codat_bills": (declared.CODAT_BILLS, LEDGER_PAGE),
    "codat_billPayments": (declared.CODAT_BILL_PAYMENTS, LEDGER_PAGE),
    "supplier": (declared.SUPPLIER, LEDGER_PAGE),
    "transactions": (declared.TRANSACTIONS, BANK_FEED),
    "trizetto_org": (declared.TRIZETTO_ORG, LEDGER_PAGE),
    "trizetto_providers": (declared.TRIZETTO_PROVIDERS, LEDGER_PAGE),
    "trizetto_claims": (declared.TRIZETTO_CLAIMS, None),
    "trizetto_payments": (declared.TRIZETTO_PAYMENTS, None),
}


def _build(name: str, names: dict[str, str], lineage: tuple[str, ...], **values) -> DatasetSpec:
    schema = _SOURCES[name][1]
    return DatasetSpec(
        name=name,
        columns=(*names, *lineage),
        renames=names,
        format="json" if schema else "delimited",
        input_schema=schema,
        **values,
    )


def _set_a(name: str) -> DatasetSpec:
    return _build(
        name,
        _SOURCES[name][0],
        declared.LINEAGE_A.get(name, LINEAGE),
        required=declared.REQUIRED_A[name],
        table=declared.TABLES_A[name],
    )


def _set_b(name: str) -> DatasetSpec:
    changes = declared.SET_B.get(name, {})
    names = {source: changes.get(source, target) for source, target in _SOURCES[name][0].items()}
    return _build(
        name,
        {source: target for source, target in names.items() if target is not None},
        declared.LINEAGE_B.get(name, ("job_id",)),
        required=declared.REQUIRED_B[name],
        casts=declared.SET_B_CASTS.get(name, {}),
        tenant_target="comp_id" if name in declared.TENANT_B else "company_id",
        table=declared.TABLES_B[name],
    )


def _without_load_date(spec: DatasetSpec, name: str) -> DatasetSpec:
    return replace(spec, name=name, columns=tuple(c for c in spec.columns if c != "file_load_dt"), table=declared.TABLES_B[name])


SET_A = {name: _set_a(name) for name in _SOURCES}
SET_B = {name: _set_b(name) for name in _SOURCES}
SET_B["trizetto_v1_claims"] = _without_load_date(SET_B["trizetto_claims"], "trizetto_v1_claims")
SET_B["trizetto_v1_payments"] = _without_load_date(SET_B["trizetto_payments"], "trizetto_v1_payments")

MONTHLY_INVOICE = replace(SET_A["invoice"], name="monthly_invoice", table="STG_INVOICES", tenant_column=None)

DAILY_BALANCE = HistorySpec(
    keys=declared.DAILY_KEYS,
    value=declared.DAILY_VALUE,
    value_type="decimal(28,10)",
    partition_column="bal_dt",
    stage_table=declared.DAILY_STAGE_TABLE,
    history_table=declared.DAILY_HISTORY_TABLE,
)
