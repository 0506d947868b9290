"""Column names and types of the raw inputs."""

from monthmill import fixed_values as fixed

# Target types of the loan table after cleaning.
LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}

# Types in the raw loan file: amounts arrive in full precision.
RAW_LOAN_TYPES = {n: "double" if t == "float" else t for n, t in LOAN_TYPES.items()}

ATTRIBUTE_COLUMNS = ("Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date")
CLICKSTREAM_COLUMNS = (*fixed.CLICKSTREAM_FEATURES, "Customer_ID", "snapshot_date")
FINANCIAL_COLUMNS = (*fixed.FINANCIAL_TEXT_COLUMNS, *fixed.FINANCIAL_NUMERIC_TYPES, "snapshot_date")

TRANSACTION_TYPES = {
    "Quantity": "int",
    "UnitPrice": "double",
    "CustomerID": "bigint",
}

# Daily index returns: types by the name in the file, and names that need no quoting.
INDEX_TYPES = {"Date": "date", "EWU": "double", "^FTAS": "double", "^FTMC": "double", "^FTSE": "double"}
INDEX_NAMES = {"Date": "date", "EWU": "ewu", "^FTAS": "ftas", "^FTMC": "ftmc", "^FTSE": "ftse"}
