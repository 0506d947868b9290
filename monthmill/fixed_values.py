"""Names, codes, probabilities and patterns the results depend on."""

# --- credit pipeline -------------------------------------------------------------

# Numeric columns of the raw financial snapshot and their types.
FINANCIAL_NUMERIC_TYPES = {
    "Annual_Income": "float",
    "Monthly_Inhand_Salary": "float",
    "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int",
    "Interest_Rate": "float",
    "Num_of_Loan": "int",
    "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "float",
    "Num_Credit_Inquiries": "float",
    "Outstanding_Debt": "float",
    "Credit_Utilization_Ratio": "float",
    "Total_EMI_per_month": "float",
    "Amount_invested_monthly": "float",
    "Monthly_Balance": "float",
}

# Text columns of the raw financial snapshot.
FINANCIAL_TEXT_COLUMNS = (
    "Customer_ID",
    "Type_of_Loan",
    "Credit_Mix",
    "Credit_History_Age",
    "Payment_of_Min_Amount",
    "Payment_Behaviour",
)

# Accepted ranges (lower, upper); a value outside becomes null.
FINANCIAL_RANGES = {
    "Annual_Income": (0, None),
    "Monthly_Balance": (0, None),
    "Credit_Utilization_Ratio": (None, 100),
    "Interest_Rate": (None, 48),
}
AGE_RANGE = (18, 99)

# Column names, dummies and patterns.
CLICKSTREAM_FEATURES = tuple(f"fe_{i}" for i in range(1, 21))
CLICKSTREAM_MISSING = "-1"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
OCCUPATION_DUMMY = "_______"
YEARS_PATTERN = r"(\d+)\s+Year"
MONTHS_PATTERN = r"(\d+)\s+Month"
PAYMENT_ORDINALS = {"Poor": 1, "Standard": 2, "Good": 3, "Excellent": 4}
PAYMENT_DEFAULT = 2
LABEL_DPD = 30
LABEL_MOB = 6

# Columns the median imputation leaves alone.
NOT_IMPUTED = (
    "Customer_ID",
    "loan_id",
    "snapshot_date",
    "loan_start_date",
    "dpd",
    "overdue_amt",
    "installments_missed",
    "first_missed_date",
    "balance",
    "paid_amt",
    "SSN",
    "Occupation",
    "Payment_of_Min_Amount",
    "financials_lag_days",
    "attributes_lag_days",
)
IMPUTED_TYPES = ("double", "float", "int", "bigint")

# Source text columns that the encodings replace.
ENCODED_SOURCES = ("Credit_History_Age", "Payment_Behaviour", "Credit_Mix", "Type_of_Loan")

# --- retail analysis -------------------------------------------------------------

# Stock codes that are not products (anomaly report; product ranking).
NON_PRODUCT_CODES = ("POST", "D", "DOT", "M", "S", "AMAZONFEE", "BANK CHARGES")
NON_PRODUCT_CODES_WIDE = (*NON_PRODUCT_CODES, "PADS", "CRUK")

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
HOME_COUNTRY = "United Kingdom"

# --- customer metadata -----------------------------------------------------------

# Countries of the region "Western Europe".
WESTERN_EUROPE = (
    "Germany", "France", "Netherlands", "Belgium", "Spain",
    "Portugal", "Switzerland", "Austria", "Denmark", "Sweden",
    "Norway", "Finland", "Italy", "EIRE", "Channel Islands", "Cyprus",
    "Poland", "Czech Republic", "Lithuania", "Greece", "Malta",
)

# Account managers and the label of customers without one.
ACCOUNT_MANAGERS = (
    "Sarah Bennett",
    "James Thornton",
    "Priya Kapoor",
    "Oliver Walsh",
    "Emily Hartley",
    "Mohammed Al-Rashid",
)
NO_MANAGER = "Self-Serve"

# Categories with their probabilities (per company size where they depend on it).
VERTICALS = {
    "Gift Shop": 0.28,
    "Homeware Retail": 0.22,
    "Online Retailer": 0.18,
    "Department Store": 0.08,
    "Market Trader": 0.12,
    "Florist": 0.06,
    "Other": 0.06,
}
CHANNELS = ("Trade Show", "Direct Sales", "Online Enquiry", "Referral", "Cold Outreach")
CHANNEL_WEIGHTS = {
    "Large": (0.35, 0.35, 0.10, 0.15, 0.05),
    "Medium": (0.25, 0.25, 0.25, 0.15, 0.10),
    "Small": (0.10, 0.10, 0.40, 0.15, 0.25),
}
TERMS_DAYS = (30, 60, 90)
TERMS_WEIGHTS = {
    "Small": (0.80, 0.15, 0.05),
    "Medium": (0.50, 0.40, 0.10),
    "Large": (0.20, 0.50, 0.30),
}

# Mean and standard deviation per company size.
CREDIT_LIMIT = {"Small": (500, 200), "Medium": (2000, 800), "Large": (10000, 3000)}
YEARS_TRADING = {"Small": (5, 3), "Medium": (10, 5), "Large": (18, 8)}
CREDIT_STEP = 250
VIP_MIN_LIMIT = 10000
