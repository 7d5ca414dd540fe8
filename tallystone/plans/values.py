"""Fixed values of the facts model, as text. Replace them to run the engine over another set of terms."""

from __future__ import annotations

#: Concept, term, statement, category of concepts mapped exactly.
EXACT = [
    tuple(line.split())
    for line in """Assets BT-024 balance_sheet assets
CashAndCashEquivalentsAtCarryingValue BT-029 balance_sheet assets
CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents BT-029 balance_sheet cash
AccountsReceivableNetCurrent BT-030 balance_sheet receivables
AccountsReceivableNet BT-030 balance_sheet receivables
InventoryNet BT-031 balance_sheet inventory
PropertyPlantAndEquipmentNet BT-032 balance_sheet ppe
Goodwill BT-033 balance_sheet goodwill
Liabilities BT-027 balance_sheet liabilities
LiabilitiesAndStockholdersEquity BT-027 balance_sheet liabilities
StockholdersEquity BT-028 balance_sheet equity
StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest BT-028 balance_sheet equity
RetainedEarningsAccumulatedDeficit BT-048 other retained_earnings
Revenues BT-022 income_statement revenue
RevenueFromContractWithCustomerExcludingAssessedTax BT-022 income_statement revenue
SalesRevenueNet BT-022 income_statement revenue
SalesRevenueGoodsNet BT-022 income_statement revenue
CostOfRevenue BT-034 income_statement cost_of_revenue
CostOfGoodsAndServicesSold BT-034 income_statement cost_of_revenue
CostOfGoodsSold BT-034 income_statement cost_of_revenue
GrossProfit BT-035 income_statement gross_profit
OperatingIncomeLoss BT-036 income_statement operating_income
NetIncomeLoss BT-023 income_statement net_income
IncomeTaxExpenseBenefit BT-037 income_statement income_tax
ResearchAndDevelopmentExpense BT-038 income_statement research_and_development
SellingGeneralAndAdministrativeExpense BT-039 income_statement sga
GeneralAndAdministrativeExpense BT-039 income_statement sga
NetCashProvidedByUsedInOperatingActivities BT-040 cash_flow operating
NetCashProvidedByUsedInInvestingActivities BT-041 cash_flow investing
NetCashProvidedByUsedInFinancingActivities BT-042 cash_flow financing
PaymentsToAcquirePropertyPlantAndEquipment BT-043 cash_flow capex
EarningsPerShareBasic BT-044 per_share eps
EarningsPerShareDiluted BT-045 per_share eps
CommonStockDividendsPerShareDeclared BT-046 per_share dividends
CommonStockDividendsPerShareCashPaid BT-046 per_share dividends
ComprehensiveIncomeNetOfTax BT-047 other comprehensive_income
OtherComprehensiveIncomeLossNetOfTax BT-047 other comprehensive_income""".splitlines()
]
#: Prefix, term, statement, category; the first that fits.
PREFIXES = [
    tuple(line.split())
    for line in """RevenueFromContract BT-022 income_statement revenue
SalesRevenue BT-022 income_statement revenue
CostOfGoods BT-034 income_statement cost_of_revenue
CostOfRevenue BT-034 income_statement cost_of_revenue
CashAndCashEquivalents BT-029 balance_sheet cash
CashCashEquivalents BT-029 balance_sheet cash
AccountsReceivable BT-030 balance_sheet receivables
Inventory BT-031 balance_sheet inventory
PropertyPlantAndEquipment BT-032 balance_sheet ppe
GoodwillAcquired BT-033 balance_sheet goodwill
GoodwillImpairment BT-033 balance_sheet goodwill
EarningsPerShare BT-044 per_share eps
CommonStockDividendsPerShare BT-046 per_share dividends
DividendsCommonStock BT-046 per_share dividends
ResearchAndDevelopment BT-038 income_statement research_and_development
SellingGeneralAndAdministrative BT-039 income_statement sga
ComprehensiveIncome BT-047 other comprehensive_income
OtherComprehensiveIncome BT-047 other comprehensive_income
RetainedEarnings BT-048 other retained_earnings""".splitlines()
]
#: Pattern (at the start of the concept), term, statement, category; the first that fits.
PATTERNS = [
    (r"(?i).*Revenue.*(?!Deferred|Remaining|Recognized)", "BT-022", "income_statement", "revenue"),
    (r"(?i).*NetIncome.*", "BT-023", "income_statement", "net_income"),
    (r"(?i).*OperatingIncome.*", "BT-036", "income_statement", "operating_income"),
    (r"(?i).*IncomeTax(?!Reconciliation|Credits|Receivable|Deferred).*ExpenseBenefit.*", "BT-037", "income_statement", "income_tax"),
    (r"(?i).*CapitalExpenditure.*", "BT-043", "cash_flow", "capex"),
]
#: Part of the concept, statement, category of unmapped concepts; the first that fits.
HEURISTICS = [
    tuple(line.split())
    for line in """Tax income_statement tax
Lease balance_sheet leases
Debt balance_sheet debt
Stock balance_sheet equity
Share per_share shares
Depreciation income_statement depreciation
Amortization income_statement amortization
Interest income_statement interest
Derivative balance_sheet derivatives
Segment other segment
Pension balance_sheet pension
Impairment income_statement impairment
Restructuring income_statement restructuring
Acquisition balance_sheet acquisitions
Receivable balance_sheet receivables
Payable balance_sheet payables
Asset balance_sheet assets
Liability balance_sheet liabilities
Equity balance_sheet equity
Revenue income_statement revenue
Expense income_statement expenses
Income income_statement income
Cash cash_flow cash
Operating income_statement operating
Investing cash_flow investing
Financing cash_flow financing""".splitlines()
]
#: Term, its unit, its concepts by preference.
PRIORITIES = {
    t[0]: (t[1], t[2:])
    for t in (
        line.split()
        for line in """BT-022 USD Revenues RevenueFromContractWithCustomerExcludingAssessedTax RevenuesNetOfInterestExpense SalesRevenueNet
BT-023 USD NetIncomeLoss
BT-024 USD Assets
BT-027 USD Liabilities
BT-028 USD StockholdersEquity StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest
BT-029 USD CashAndCashEquivalentsAtCarryingValue CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents
BT-030 USD AccountsReceivableNetCurrent
BT-031 USD InventoryNet
BT-032 USD PropertyPlantAndEquipmentNet
BT-033 USD Goodwill
BT-034 USD CostOfRevenue CostOfGoodsAndServicesSold CostOfGoodsSold
BT-035 USD GrossProfit
BT-036 USD OperatingIncomeLoss
BT-037 USD IncomeTaxExpenseBenefit
BT-038 USD ResearchAndDevelopmentExpense
BT-039 USD SellingGeneralAndAdministrativeExpense GeneralAndAdministrativeExpense
BT-040 USD NetCashProvidedByUsedInOperatingActivities
BT-041 USD NetCashProvidedByUsedInInvestingActivities
BT-042 USD NetCashProvidedByUsedInFinancingActivities
BT-043 USD PaymentsToAcquirePropertyPlantAndEquipment
BT-044 USD/shares EarningsPerShareBasic
BT-045 USD/shares EarningsPerShareDiluted
BT-046 USD/shares CommonStockDividendsPerShareDeclared CommonStockDividendsPerShareCashPaid
BT-047 USD ComprehensiveIncomeNetOfTax
BT-048 USD RetainedEarningsAccumulatedDeficit""".splitlines()
    )
}
#: Legacy ids and the terms they became.
LEGACY = {
    "CDE-007": "BT-024",
    "CDE-008": "BT-027",
    "CDE-009": "BT-028",
    "CDE-010": "BT-029",
    "CDE-011": "BT-030",
    "CDE-012": "BT-031",
    "CDE-013": "BT-032",
    "CDE-014": "BT-033",
    "CDE-015": "BT-022",
    "CDE-016": "BT-034",
    "CDE-017": "BT-035",
    "CDE-018": "BT-036",
    "CDE-019": "BT-023",
    "CDE-020": "BT-037",
    "CDE-021": "BT-038",
    "CDE-022": "BT-039",
    "CDE-023": "BT-040",
    "CDE-024": "BT-041",
    "CDE-025": "BT-042",
    "CDE-026": "BT-043",
    "CDE-027": "BT-044",
    "CDE-028": "BT-045",
    "CDE-029": "BT-046",
    "CDE-030": "BT-047",
    "CDE-031": "BT-048",
}
#: Ratio, name, numerator, denominator, is the numerator's size meant.
RATIOS = [
    ("RATIO-001", "Gross Margin", "BT-035", "BT-022", False),
    ("RATIO-002", "Operating Margin", "BT-036", "BT-022", False),
    ("RATIO-003", "Net Margin", "BT-023", "BT-022", False),
    ("RATIO-004", "Debt-to-Equity", "BT-027", "BT-028", False),
    ("RATIO-005", "R&D Intensity", "BT-038", "BT-022", False),
    ("RATIO-006", "SGA Ratio", "BT-039", "BT-022", False),
    ("RATIO-007", "CapEx-to-Revenue", "BT-043", "BT-022", True),
]
#: SIC code and sector.
SECTORS = {
    "2086": "Consumer Staples", "2834": "Healthcare", "2841": "Consumer Staples", "2911": "Energy", "3571": "Technology", "3674": "Technology",
    "3711": "Consumer Discretionary", "3721": "Industrials", "5331": "Consumer Staples", "5961": "Consumer Discretionary", "6020": "Financials", "6211": "Financials",
    "6324": "Healthcare", "6331": "Financials", "7370": "Technology", "7372": "Technology", "7389": "Financials", "7841": "Communication Services",
}
