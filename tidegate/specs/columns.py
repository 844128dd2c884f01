"""Flat source names and the staging columns they become, per dataset.

The order is that of the staging table. ``SET_B`` lists what a second deployment
names differently.
"""

ACCOUNTS = {
    "results_id": "acc_id",
    "results_nominalCode": "acc_cd",
    "results_name": "acc_name",
    "results_currentBalance": "current_bal",
    "results_currency": "acc_curr",
    "results_fullyQualifiedCategory": "fully_qualified_cat",
    "results_metadata_isDeleted": "is_deleted",
    "results_fullyQualifiedName": "fully_qualified_name",
    "results_type": "acc_type",
    "results_status": "acc_status",
    "results_isBankAccount": "bank_acc",
}

BALANCE_SHEET = {
    "reportItems_accountId": "acc_id",
    "reportItems_accountName": "acc_name",
    "reportItems_balance": "bal_amt",
    "reportItems_date": "bal_dt",
    "reportItems_accountCategory_id": "id",
    "reportItems_accountCategory_status": "status",
    "reportInfo_companyName": "company_name",
    "reportInfo_currency": "curr",
    "reportInfo_generatedDate": "generated_dt",
    "reportInfo_reportName": "report_name",
    "reportItems_accountCategory_levels_confidence": "confidence",
    "reportItems_accountCategory_levels_levelName": "level_name",
}

P_AND_L = {
    "reportInfo_companyName": "company_name",
    "reportInfo_currency": "curr",
    "reportInfo_generatedDate": "generated_dt",
    "reportInfo_reportName": "report_name",
    "reportItems_accountId": "acc_id",
    "reportItems_accountName": "acc_name",
    "reportItems_balance": "bal_amt",
    "reportItems_date": "bal_dt",
    "reportItems_accountCategory_id": "id",
    "reportItems_accountCategory_status": "status",
    "reportItems_accountCategory_levels_confidence": "confidence",
    "reportItems_accountCategory_levels_levelName": "level_name",
}

INVOICE = {
    "results_id": "invoice_id",
    "results_invoiceNumber": "invoice_no",
    "results_issueDate": "inv_issue_dt",
    "results_customerRef_id": "cust_id",
    "results_customerRef_companyName": "cust_name",
    "results_totalAmount": "total_amt",
    "results_totalTaxAmount": "total_tax_amt",
    "results_currency": "curr",
    "results_dueDate": "due_dt",
    "results_amountDue": "due_amt",
    "results_status": "status",
    "results_metadata_isDeleted": "is_deleted",
}

PAYMENTS = {
    "results_id": "pay_id",
    "results_customerRef_id": "cust_id",
    "results_accountRef_name": "cust_name",
    "results_accountRef_id": "pay_acc_id",
    "results_customerRef_companyName": "pay_acc_name",
    "results_totalAmount": "pay_total_amt",
    "results_currency": "pay_curr",
    "results_date": "pay_dt",
    "results_note": "pay_note",
    "results_lines_amount": "line_amt",
    "results_metadata_isDeleted": "is_deleted",
    "results_lines_links_id": "invoice_id",
    "results_lines_links_amount": "invoice_amt",
}

CODAT_BILLS = {
    "results_id": "bill_id",
    "results_supplierRef_id": "supplier_id",
    "results_supplierRef_supplierName": "supplier_name",
    "results_issueDate": "bills_issue_dt",
    "results_dueDate": "bills_due_dt",
    "results_totalAmount": "total_amt",
    "results_amountDue": "due_amt",
    "results_currency": "bills_curr",
    "results_metadata_isDeleted": "is_deleted",
    "results_lineItems_accountRef_name": "reference",
}

CODAT_BILL_PAYMENTS = {
    "results_id": "bill_pay_id",
    "results_supplierRef_id": "supplier_id",
    "results_supplierRef_supplierName": "supplier_name",
    "results_date": "bill_pay_dt",
    "results_modifiedDate": "bill_mod_dt",
    "results_totalAmount": "total_amt",
    "results_amountDue": "bill_due_amt",
    "results_currency": "bill_pay_curr",
    "results_currencyRate": "curr_rate",
    "results_metadata_isDeleted": "is_deleted",
    "results_note": "note",
}

SUPPLIER = {
    "results_id": "supplier_id",
    "results_supplierName": "company_name",
    "results_contactName": "contact_name",
    "results_emailAddress": "email_id",
    "results_phone": "phone_no",
    "results_taxNumber": "tax_no",
    "results_addresses_city": "supplier_address",
    "results_metadata_isDeleted": "is_deleted",
}

TRANSACTIONS = {
    "accounts_account_id": "acc_id",
    "accounts_balances_available": "bal_available",
    "accounts_balances_current": "bal_current",
    "accounts_balances_iso_currency_code": "iso_curr_code",
    "accounts_name": "acc_name",
    "accounts_official_name": "acc_official_name",
    "accounts_subtype": "subtype",
    "transactions_account_id": "trans_acc_id",
    "transactions_amount": "trans_amt",
    "transactions_category": "trans_cat",
    "transactions_name": "trans_name",
    "transactions_date": "trans_dt",
    "transactions_transaction_id": "trans_id",
    "transactions_pending": "is_pending",
}

# Organizations and providers share their columns; organizations name the id differently.
TRIZETTO_PROVIDERS = {
    "results_id": "pay_id",
    "results_customerRef_id": "cust_id",
    "results_accountRef_name": "cust_name",
    "results_accountRef_id": "pay_acc_id",
    "results_customerRef_companyName": "pay_acc_name",
    "results_lines_amount": "pay_total_amt",
    "results_currency": "pay_curr",
    "results_date": "pay_dt",
    "results_note": "pay_note",
    "results_lines_links_amount": "pay_lines",
    "results_metadata_isDeleted": "is_deleted",
}
TRIZETTO_ORG = {**TRIZETTO_PROVIDERS, "results_id": "org_id"}

TRIZETTO_CLAIMS = {
    "Identifier": "claim_id",
    "OrgIdentifier": "org_id",
    "BillingProviderNPI": "bill_prov_npi",
    "RenderingProviderNPI": "rend_prov_npi",
    "ClaimDate": "claim_dt",
    "TotalAmount": "total_amt",
    "BilledAmount": "bill_amt",
    "PrimaryPayerId": "primary_payer_id",
    "SecondaryPayerId": "secondary_payer_id",
    "DiagnosisCode": "diagnosis_cd",
    "StatusDate": "status_dt",
    "ClaimAckCode": "claim_ack_cd",
    "RecordCreationDate": "record_creation_dt",
    "PrimaryPayerType": "primary_payer_type",
    "ReceivedDate": "received_dt",
    "ServiceLineIdentifier": "service_line_id",
    "ClaimIdentifier": "claim_id_v1",
    "ProcedureCode": "procedure_cd",
    "ChargeAmount": "charge_amt",
    "StartServiceDate": "start_service_dt",
    "EndServiceDate": "end_service_dt",
}

TRIZETTO_PAYMENTS = {
    "PaymentIdentifier": "pay_id",
    "ClaimIdentifier": "claim_id",
    "OrgIdentifier": "org_id",
    "BillingProviderNPI": "bill_prov_npi",
    "RenderingProviderNPI": "rend_prov_npi",
    "PaymentDate": "pay_dt",
    "PaymentAmount": "pay_amt",
    "ProcessingStatusCode": "processing_status_cd",
    "PayeeName": "payee_name",
    "CheckNumber": "check_no",
    "CheckDate": "check_dt",
    "ChargeAmount": "charge_amt",
    "PaidAmount": "paid_amt",
    "DeductableAmount": "deductable_amt",
    "DiscountAmount": "discount_amt",
    "CoInsAmount": "co_ins_amt",
    "CoPaymentAmount": "co_pay_amt",
    "AdjustReasonCode": "adj_reason_cd",
    "RemarkCode": "remark_cd",
    "LateFilingCharge": "late_filing_charge",
    "InterestAmount": "interest_amt",
    "DenialType": "denial_type",
    "RecordCreationDate": "record_creation_dt",
}

# Columns that set B names differently (a target) or leaves out (None).
SET_B = {
    "accounts": {"results_currency": "curr"},
    "balance_sheet": {
        "reportItems_accountCategory_id": "cat_id",
        "reportItems_accountCategory_status": "cat_status",
        "reportInfo_companyName": "comp_name",
        "reportInfo_generatedDate": "gen_dt",
    },
    "p_and_l": {
        "reportInfo_companyName": "comp_name",
        "reportInfo_generatedDate": "gen_dt",
        "reportItems_balance": "pnl_amt",
        "reportItems_date": "pnl_dt",
        "reportItems_accountCategory_id": "cat_id",
        "reportItems_accountCategory_status": "cat_status",
    },
    "codat_bills": {"results_currency": "curr"},
    "codat_billPayments": {
        "results_modifiedDate": None,
        "results_amountDue": None,
        "results_currency": "curr",
    },
}

# Casts that set B declares.
SET_B_CASTS = {
    "accounts": {"results_currentBalance": "double", "results_currencyRate": "double"},
    "balance_sheet": {
        "reportItems_balance": "double",
        "reportItems_date": "date",
        "reportInfo_generatedDate": "date",
        "reportItems_accountCategory_levels_confidence": "integer",
    },
    "p_and_l": {
        "reportItems_balance": "double",
        "reportItems_date": "date",
        "reportInfo_generatedDate": "date",
        "reportItems_accountCategory_levels_confidence": "integer",
    },
    "codat_bills": {
        "results_totalAmount": "double",
        "results_amountDue": "double",
        "results_issueDate": "date",
        "results_dueDate": "date",
    },
    "codat_billPayments": {
        "results_totalAmount": "double",
        "results_currencyRate": "double",
        "results_date": "date",
    },
}

# Lineage columns per set: all three, or the ones listed.
LINEAGE_A = {
    "p_and_l": ("job_id", "file_load_dt"),
    "codat_bills": ("job_id", "file_load_dt"),
    "codat_billPayments": ("job_id", "file_load_dt"),
    "transactions": ("job_id", "file_load_dt"),
    "trizetto_claims": ("job_id", "file_load_dt"),
    "trizetto_payments": ("job_id", "file_load_dt"),
}
LINEAGE_B = {
    "trizetto_claims": ("job_id", "file_load_dt"),
    "trizetto_payments": ("job_id", "file_load_dt"),
    "trizetto_org": ("job_id", "file_name", "file_load_dt"),
}

# Columns that must not be null, as declared (some name no output column; see repaired()).
REQUIRED_A = {
    "accounts": ("acc_id", "id"),
    "balance_sheet": ("acc_id", "id"),
    "p_and_l": ("acc_id", "company_name"),
    "invoice": ("invoice_id", "invoice_no"),
    "payments": ("pay_id",),
    "codat_bills": ("bill_id",),
    "codat_billPayments": ("bill_pay_id",),
    "supplier": ("supplier_id",),
    "transactions": ("acc_id",),
    "trizetto_org": ("pay_id",),
    "trizetto_providers": ("pay_id",),
    "trizetto_claims": (),
    "trizetto_payments": ("pay_id", "org_id"),
}
REQUIRED_B = {
    **REQUIRED_A,
    "balance_sheet": ("acc_id", "cat_id"),
    "p_and_l": ("acc_id", "cat_id"),
}

# Staging tables of set A.
TABLES_A = {
    "accounts": "STG_A_ACCOUNTS",
    "balance_sheet": "STG_A_FS_BAL_ST",
    "p_and_l": "STG_A_FS_PnL",
    "invoice": "STG_A_INVOICES",
    "payments": "STG_A_PAYMENTS",
    "codat_bills": "STG_A_BILLS",
    "codat_billPayments": "STG_A_BILL_PAYMENTS",
    "supplier": "STG_A_SUPPLIERS",
    "transactions": "STG_B_BANK_TRANSACTIONS",
    "trizetto_org": "STG_T_ORGANIZATIONS",
    "trizetto_providers": "STG_T_PROVIDERS",
    "trizetto_claims": "STG_T_V_CLAIMS",
    "trizetto_payments": "STG_T_V_PAYMENTS",
}
# Staging tables of set B, with their schema where one is declared.
TABLES_B = {
    "accounts": "layera_staging.stg_a_accounts",
    "balance_sheet": "layera_staging.stg_a_fs_bal_st",
    "p_and_l": "layera_staging.stg_a_fs_pnl_st",
    "invoice": "layera_staging.stg_a_invoices",
    "payments": "layera_staging.stg_a_payments",
    "codat_bills": "layera_staging.stg_a_bills",
    "codat_billPayments": "layera_staging.stg_a_bill_payments",
    "supplier": "layera_staging.stg_a_suppliers",
    "transactions": "layera_staging.stg_b_transactions",
    "trizetto_org": "layera_staging.stg_t_organizations",
    "trizetto_providers": "layera_staging.stg_t_providers",
    "trizetto_claims": "STG_T_V_CLAIMS",
    "trizetto_payments": "STG_T_V_PAYMENTS",
    "trizetto_v1_claims": "layera_staging.stg_t_v1_claims",
    "trizetto_v1_payments": "layera_staging.stg_t_v1_payments",
}
# Datasets whose tenant column set B calls comp_id.
TENANT_B = (
    "accounts", "balance_sheet", "p_and_l", "invoice", "codat_bills", "codat_billPayments", "supplier",
)

# The daily balance table.
DAILY_KEYS = ("company_name", "level_name", "acc_id", "acc_name", "bal_dt")
DAILY_VALUE = "bal_amt"
DAILY_STAGE_TABLE = "STG_FS_BAL_ST_V"
DAILY_HISTORY_TABLE = "DAILY_FS_BAL_ST_TESTING_V"
