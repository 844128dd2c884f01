"""Input schemas of the nested sources, so that reads need no inference pass."""

LEDGER_PAGE = (
    "_links struct<self: struct<href: string>>, "
    "results array<struct<"
    "id: string, nominalCode: string, name: string, type: string, status: string, note: string, "
    "invoiceNumber: string, issueDate: string, dueDate: string, date: string, modifiedDate: string, "
    "currency: string, currencyRate: double, currentBalance: double, "
    "totalAmount: double, totalTaxAmount: double, amountDue: double, "
    "fullyQualifiedCategory: string, fullyQualifiedName: string, isBankAccount: boolean, "
    "supplierName: string, contactName: string, emailAddress: string, phone: string, taxNumber: string, "
    "customerRef: struct<id: string, companyName: string>, "
    "supplierRef: struct<id: string, supplierName: string>, "
    "accountRef: struct<id: string, name: string>, "
    "metadata: struct<isDeleted: boolean>, "
    "lines: array<struct<amount: double, links: array<struct<id: string, amount: double>>>>, "
    "lineItems: array<struct<accountRef: struct<name: string>>>, "
    "addresses: array<struct<city: string>>>>"
)

FINANCIAL_REPORT = (
    "reportInfo struct<companyName: string, currency: string, generatedDate: string, reportName: string>, "
    "reportItems array<struct<accountId: string, accountName: string, balance: double, date: string, "
    "accountCategory: struct<id: string, status: string, "
    "levels: array<struct<confidence: int, levelName: string>>>>>, "
    "_links struct<self: struct<href: string>>"
)

BANK_FEED = (
    "accounts array<struct<account_id: string, "
    "balances: struct<available: double, current: double, iso_currency_code: string>, "
    "name: string, official_name: string, subtype: string>>, "
    "transactions array<struct<account_id: string, amount: double, category: array<string>, name: string, "
    "date: string, transaction_id: string, pending: boolean>>, "
    "_links struct<self: struct<href: string>>"
)
