"""Reference SQL for the registered queries, in the dialect of DuckDB.

``VIEWS`` derives the raw inputs from the test tables, ``LAYERS`` the cleaned tables. A query
gets the definitions it names, and those they need, as leading common table expressions.
"""

from __future__ import annotations

import re

from monthmill import fixed_values as fixed
from monthmill.catalog.views import LABELLED_UNTIL, OBSERVED_UNTIL

CLICKS = [f"fe_{i}" for i in range(1, 21)]

VIEWS = {
    "retail_tx": """
select case when o_orderstatus = 'P' and o_orderkey % 10 = 0 then 'C' else '' end || o_orderkey as InvoiceNo,
       case when l_partkey % 97 = 0 then 'POST' when l_partkey % 89 = 0 then 'pads'
            else cast(l_partkey as varchar) end as StockCode,
       case when l_partkey % 53 <> 0 then p_name end as Description,
       cast(case when o_orderstatus = 'P' and o_orderkey % 10 = 0 then -l_quantity else l_quantity end as int)
         as Quantity,
       o_orderdate + to_seconds((o_orderkey * 613) % 86400) as InvoiceDate,
       case when l_linenumber = 7 and l_partkey % 11 = 0 then 0.0::double
            when l_partkey % 499 = 0 then -1.0::double
            else floor(l_extendedprice / l_quantity) / 4 end as UnitPrice,
       case when o_orderkey % 4 <> 0 then o_custkey end as CustomerID,
       case when n_nationkey < 10 then 'United Kingdom' when n_nationkey = 10 then 'Germany'
            when n_nationkey = 11 then 'France' when n_nationkey = 12 then 'EIRE' else n_name end as Country
from lineitem join orders on l_orderkey = o_orderkey
     left join customer on o_custkey = c_custkey
     left join nation on c_nationkey = n_nationkey
     left join part on l_partkey = p_partkey""",
    "loan_daily": """
select 'L' || o_orderkey as loan_id, 'CUS_' || o_custkey as Customer_ID,
       cast(date_trunc('month', o_orderdate) as date) as loan_start_date,
       cast(6 as int) as tenure, cast(i as int) as installment_num,
       floor(o_totalprice) as loan_amt,
       case when i = 0 or o_orderkey % 101 = 0 then 0.0::double else floor(o_totalprice / 6) end as due_amt,
       case when i > 0 and (o_orderkey + i) % 5 <> 0 then floor(o_totalprice / 6) else 0.0::double end
         as paid_amt,
       case when o_orderkey % 37 = 0 then null
            when i > 0 and (o_orderkey + i) % 5 = 0
            then floor(o_totalprice / 6 * (o_orderkey % 4 + 0.5::double))
            else 0.0::double end as overdue_amt,
       floor(o_totalprice * (6 - i) / 6) as balance,
       cast(date_trunc('month', o_orderdate) + to_months(cast(i as int)) as date) as snapshot_date
from orders, unnest(range(0, 7)) as steps(i)""",
    "financials_raw": """
select 'CUS_' || c as Customer_ID,
       cast(cast(date '1995-01-01' + to_months(cast((c * 7 + j * 23) % 80 as int)) as date) as varchar)
         as snapshot_date,
       case when c % 11 = 0 then '' when c % 13 = 0 then '-500'
            when c % 7 = 0 then (20000 + c + j) || '_' else cast(20000 + c + j as varchar) end as Annual_Income,
       (c % 9) || case when c % 6 = 0 then '__' else '' end as Num_of_Loan,
       case when c % 50 = 0 then '5789' else cast(c % 48 as varchar) end as Interest_Rate,
       case when c % 13 = 0 then '_' when c % 5 = 0 then 'Bad' when c % 5 < 3 then 'Standard' else 'Good' end
         as Credit_Mix,
       case c % 4 when 1 then 'Auto Loan' when 2 then 'Payday Loan, Home Equity Loan'
            when 3 then 'Auto Loan, Credit-Builder Loan, and Payday Loan' end as Type_of_Loan,
       case when c % 17 = 0 then 'NA' when c % 19 = 0 then '3 Years'
            else (c % 30) || ' Years and ' || (j + 1) || ' Months' end as Credit_History_Age,
       cast(2000 + c % 3000 as varchar) as Monthly_Inhand_Salary,
       cast(c % 12 as varchar) as Num_Bank_Accounts, cast(c % 15 as varchar) as Num_Credit_Inquiries,
       (c % 7) || '_' as Num_Credit_Card, cast(c % 60 - 5 as varchar) as Delay_from_due_date,
       case when c % 31 = 0 then '' else (c % 25) || '.0' end as Num_of_Delayed_Payment,
       case when c % 41 = 0 then '_' else cast(c % 20 as varchar) end as Changed_Credit_Limit,
       (500 + c) || '_' as Outstanding_Debt, cast(c % 125 as varchar) as Credit_Utilization_Ratio,
       case c % 3 when 0 then 'Yes' when 1 then 'No' else 'NM' end as Payment_of_Min_Amount,
       cast(c % 400 as varchar) as Total_EMI_per_month,
       case when c % 43 = 0 then '__10000__' else cast(c % 900 as varchar) end as Amount_invested_monthly,
       case c % 6 when 0 then 'Poor' when 1 then 'Standard' when 2 then 'Good' when 3 then 'Excellent'
            when 4 then '!@9#%8' end as Payment_Behaviour,
       cast(c % 700 - 20 as varchar) as Monthly_Balance
from (select c_custkey as c, j from customer, unnest(range(0, 3)) as steps(j))""",
    "attributes_raw": """
select case when c % 29 <> 0 then 'CUS_' || c end as Customer_ID,
       cast(cast(date '1995-01-01' + to_months(cast((c * 5 + j * 41) % 80 as int)) as date) as varchar)
         as snapshot_date,
       c_name as Name, (c % 130) || case when c % 8 = 0 then '_' else '' end as Age,
       case when c % 9 = 0 then '#F%$D@*&8'
            else substr(cast(100000000 + c * 7919 as varchar), 1, 3) || '-'
              || substr(cast(100000000 + c * 7919 as varchar), 4, 2) || '-'
              || substr(cast(100000000 + c * 7919 as varchar), 6, 4) end as SSN,
       case when c % 10 = 0 then '_______' when c % 23 = 0 then ' ' else c_mktsegment end as Occupation
from (select c_custkey as c, c_name, c_mktsegment, j from customer, unnest(range(0, 2)) as steps(j))""",
    "clickstream_raw": f"""
select case when c % 10 <> 9 then 'CUS_' || c end as Customer_ID,
       cast(cast(date '1995-01-01' + to_months(cast(m as int)) as date) as varchar) as snapshot_date,
       {", ".join(f"cast((c * {i} + m * 7) % 200 - 1 as varchar) as fe_{i}" for i in range(1, 21))}
from (select c_custkey as c, m from customer, unnest(range(0, 87)) as steps(m))""",
}


def _number(name: str, kind: str) -> str:
    text = f"nullif(trim(regexp_replace({name}, '_+$', '')), '')"
    if kind == "int":
        value = f"cast(trunc(try_cast({text} as double)) as int)"
    else:
        value = f"try_cast({text} as float)"
    low, high = fixed.FINANCIAL_RANGES.get(name, (None, None))
    if low is not None:
        value = f"case when {value} < {low} then null else {value} end"
    if high is not None:
        value = f"case when {value} > {high} then null else {value} end"
    return f"{value} as {name}"


_TEXTS = [c for c in fixed.FINANCIAL_TEXT_COLUMNS if c != "Customer_ID"]
_HISTORY = (
    "try_cast(nullif(regexp_extract(Credit_History_Age, '(\\d+)\\s+Year', 1), '') as int) * 12"
    " + try_cast(nullif(regexp_extract(Credit_History_Age, '(\\d+)\\s+Month', 1), '') as int)"
)
_ORDINAL = (
    "cast(case Payment_Behaviour when 'Poor' then 1 when 'Standard' then 2 when 'Good' then 3"
    " when 'Excellent' then 4 else 2 end as int)"
)
_MIXES = {"credit_mix_bad": "Bad", "credit_mix_good": "Good", "credit_mix_standard": "Standard", "credit_mix__": "_"}
_KINDS = {
    "has_loan_auto_loan": "Auto Loan",
    "has_loan_credit_builder_loan": "Credit-Builder Loan",
    "has_loan_home_equity_loan": "Home Equity Loan",
    "has_loan_payday_loan": "Payday Loan",
}
_MIX_FLAGS = [f"cast(case when Credit_Mix = '{v}' then 1 else 0 end as int) as {n}" for n, v in _MIXES.items()]
_KIND_FLAGS = [
    f"cast(case when contains(Type_of_Loan, '{v}') then 1 else 0 end as int) as {n}" for n, v in _KINDS.items()
]

LAYERS = {
    "loans": """
with typed as (
  select loan_id, Customer_ID, loan_start_date, snapshot_date, tenure, installment_num,
         cast(loan_amt as float) as loan_amt, cast(due_amt as float) as due_amt,
         cast(paid_amt as float) as paid_amt, cast(overdue_amt as float) as overdue_amt,
         cast(balance as float) as balance
  from loan_daily),
counted as (
  select * replace (coalesce(overdue_amt, 0) as overdue_amt), installment_num as mob,
         coalesce(cast(ceil(cast(overdue_amt as double) / nullif(cast(due_amt as double), 0)) as int), 0)
           as installments_missed
  from typed),
dated as (
  select *, case when installments_missed > 0
            then cast(snapshot_date - to_months(installments_missed) as date) end as first_missed_date
  from counted)
select *, cast(case when overdue_amt > 0 then date_diff('day', first_missed_date, snapshot_date) else 0 end
               as int) as dpd
from dated""",
    "fin": f"""
select Customer_ID, cast(snapshot_date as date) as snapshot_date, {", ".join(_TEXTS)},
       {", ".join(_number(n, t) for n, t in fixed.FINANCIAL_NUMERIC_TYPES.items())}
from financials_raw""",
    "attr": """
with parsed as (
  select *, cast(trunc(try_cast(regexp_replace(Age, '_+$', '') as double)) as int) as years
  from attributes_raw where Customer_ID is not null and snapshot_date is not null)
select Customer_ID, cast(snapshot_date as date) as snapshot_date,
       case when years between 18 and 99 then years end as Age,
       case when regexp_full_match(SSN, '\\d{3}-\\d{2}-\\d{4}') then SSN end as SSN,
       case when Occupation = '_______' or trim(Occupation) = '' then null else Occupation end as Occupation
from parsed""",
    "clicks": f"""
select Customer_ID, cast(snapshot_date as date) as snapshot_date,
       {", ".join(f"try_cast(nullif({f}, '-1') as float) as {f}" for f in CLICKS)}
from clickstream_raw where Customer_ID is not null and snapshot_date is not null""",
    "encoded": f"""
select *, {_HISTORY} as Credit_History_Age_months, {_ORDINAL} as Payment_Behaviour_encoded,
       {", ".join(_MIX_FLAGS)}, {", ".join(_KIND_FLAGS)}
from fin""",
    "sales": """
select *, cast(Quantity * UnitPrice as decimal(18, 4)) as Revenue
from retail_tx
where not starts_with(InvoiceNo, 'C') and CustomerID is not null and Quantity > 0 and UnitPrice > 0""",
    "customers": """
select CustomerID, count(distinct InvoiceNo) as Orders, sum(Revenue) as exact_revenue,
       cast(sum(Revenue) as double) as Revenue, cast(sum(Quantity) as bigint) as Items,
       min(InvoiceDate) as FirstOrder, max(InvoiceDate) as LastOrder,
       cast(sum(Revenue) as double) / count(distinct InvoiceNo) as AvgOrderValue,
       date_sub('day', min(InvoiceDate), max(InvoiceDate)) as TenureDays
from sales group by CustomerID""",
    "products": """
select StockCode, Description, sum(Revenue) as Revenue, cast(sum(Quantity) as bigint) as Qty_sold,
       count(distinct InvoiceNo) as Unique_orders, count(distinct CustomerID) as Unique_customers
from sales
where Description is not null
  and upper(StockCode) not in ('POST', 'D', 'DOT', 'M', 'S', 'AMAZONFEE', 'BANK CHARGES', 'PADS', 'CRUK')
group by StockCode, Description""",
    "baskets": """
select InvoiceNo, cast(sum(Revenue) as double) as Revenue, cast(sum(Quantity) as bigint) as Items,
       count(distinct StockCode) as SKUs, min(CustomerID) as Customer
from sales group by InvoiceNo""",
    "countries": """
select Country, count(distinct InvoiceNo) as Orders, count(distinct CustomerID) as Customers,
       cast(sum(Revenue) as double) as Revenue,
       round_even(cast(sum(Revenue) as double)
         / (select cast(sum(Revenue) as double) from sales where Country is not null) * 100, 2) as Revenue_pct
from sales where Country is not null group by Country""",
    "pareto": """
select CustomerID, Revenue, row_number() over best as Position,
       cast(sum(exact_revenue) over (best rows unbounded preceding) as double)
         / cast(sum(exact_revenue) over () as double) * 100 as CumRevPct,
       row_number() over best / cast(count(*) over () as double) * 100 as CustPct
from customers window best as (order by exact_revenue desc, CustomerID)""",
    "long_tail": """
select StockCode, Description, cast(Revenue as double) as Revenue, row_number() over best as Position,
       cast(sum(Revenue) over (best rows unbounded preceding) as double)
         / cast(sum(Revenue) over () as double) * 100 as CumRevPct
from products window best as (order by Revenue desc, StockCode, Description)""",
    "rfm": """
select CustomerID,
       date_sub('day', LastOrder, (select max(InvoiceDate) from sales) + interval 1 day) as Recency,
       Orders as Frequency, Revenue as Monetary
from customers""",
    "scores": """
with edges as (select quantile_cont(cast(Recency as double), [0.2, 0.4, 0.6, 0.8]) as e from rfm),
ranked as (
  select *, row_number() over (order by Frequency, CustomerID) as f,
         row_number() over (order by Monetary, CustomerID) as m, count(*) over () as n
  from rfm),
scored as (
  select CustomerID, Recency, Frequency, Monetary,
         cast(5 - cast(Recency > e[1] as int) - cast(Recency > e[2] as int) - cast(Recency > e[3] as int)
                - cast(Recency > e[4] as int) as int) as R_score,
         cast(greatest(1, ((f - 1) * 5 + n - 2) // (n - 1)) as int) as F_score,
         cast(greatest(1, ((m - 1) * 5 + n - 2) // (n - 1)) as int) as M_score
  from ranked, edges)
select *, R_score + F_score + M_score as RFM_score,
       case when R_score >= 4 and F_score >= 4 then 'Champions'
            when R_score >= 3 and F_score >= 3 then 'Loyal'
            when R_score >= 4 and F_score <= 2 then 'New/Promising'
            when R_score = 2 and F_score >= 3 then 'At Risk'
            when R_score <= 2 and F_score >= 4 then 'Cant Lose Them'
            when R_score <= 2 and F_score <= 2 then 'Lost'
            else 'Needs Attention' end as Segment
from scored""",
    "churned": f"""
select CustomerID,
       cast(case when max(InvoiceDate) filter (InvoiceDate <= timestamp '{LABELLED_UNTIL}')
                   > timestamp '{OBSERVED_UNTIL}' then 0 else 1 end as int) as Churned
from sales group by CustomerID having min(InvoiceDate) <= timestamp '{OBSERVED_UNTIL}'""",
    "home": """
select CustomerID, arg_max(Country, (n, -place)) as primary_country
from (select CustomerID, Country, count(*) as n,
             row_number() over (partition by CustomerID order by Country) as place
      from sales where Country is not null group by CustomerID, Country)
group by CustomerID""",
    "tiers": """
select c.CustomerID, c.Revenue as total_revenue, Orders as order_count, FirstOrder as first_order,
       primary_country,
       case when c.Revenue >= p90 then 'Large' when c.Revenue >= p60 then 'Medium' else 'Small' end
         as company_size,
       cast(c.Revenue >= p90 as int) as is_vip,
       case when primary_country = 'United Kingdom' then 'UK'
            when primary_country in ('Germany', 'France', 'EIRE') then 'Western Europe'
            else 'Rest of World' end as region
from customers c left join home using (CustomerID),
     (select quantile_cont(Revenue, 0.6) as p60, quantile_cont(Revenue, 0.9) as p90 from customers)""",
}


def _uniform(name: str) -> str:
    return f"((cast('0x' || substr(md5(CustomerID || '|42-{name}'), 1, 8) as bigint) + 0.5::double) / 4294967296.0::double)"


def _normal(name: str) -> str:
    return (
        f"(sqrt(-2 * ln({_uniform(name + '-radius')}))"
        f" * cos(6.283185307179586::double * {_uniform(name + '-angle')}))"
    )


def _pick(uniform: str, values, weights, quote: bool = True) -> str:
    total, arms = 0.0, []
    shown = [f"'{v}'" if quote else str(v) for v in values]
    for value, weight in list(zip(shown, weights))[:-1]:
        total += weight
        arms.append(f"when {uniform} < {round(total, 10)}::double then {value}")
    return f"case {' '.join(arms)} else {shown[-1]} end"


def _by_size(cells: dict[str, str]) -> str:
    return "case company_size " + " ".join(f"when '{s}' then {c}" for s, c in cells.items()) + " end"


def _noisy(name: str, levels) -> str:
    return _by_size({s: f"({m}::double + {d}::double * {_normal(name)})" for s, (m, d) in levels.items()})


_LIMIT = f"greatest(250, floor({_noisy('limit', fixed.CREDIT_LIMIT)} / 250) * 250)"
LAYERS["metadata"] = f"""
select CustomerID as customer_id, company_size,
       {_pick(_uniform("vertical"), fixed.VERTICALS, fixed.VERTICALS.values())} as vertical,
       {_by_size({s: _pick(_uniform("channel"), fixed.CHANNELS, w) for s, w in fixed.CHANNEL_WEIGHTS.items()})}
         as onboard_channel,
       region,
       case when company_size = 'Small' then 'Self-Serve'
            else ['Sarah Bennett', 'James Thornton', 'Priya Kapoor', 'Oliver Walsh', 'Emily Hartley',
                  'Mohammed Al-Rashid'][CustomerID % 6 + 1] end as account_manager,
       cast(case when is_vip = 1 then greatest({_LIMIT}, 10000) else {_LIMIT} end as int) as credit_limit_gbp,
       cast({_by_size({s: _pick(_uniform("terms"), fixed.TERMS_DAYS, w, False) for s, w in fixed.TERMS_WEIGHTS.items()})}
            as int) as payment_terms_days,
       cast(greatest(1, round_even({_noisy("years", fixed.YEARS_TRADING)}, 0)) as int) as years_in_business,
       is_vip
from tiers"""


def _wide(prefix: str, names, types) -> str:
    """Columns by name, 32-bit floats as doubles."""
    return ", ".join(
        f"cast({prefix}{n} as double) as {n}" if types.get(n) == "float" else f"{prefix}{n} as {n}" for n in names
    )


_LOAN_TYPES = {n: "float" for n in ("loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance")}
_LOAN_COLUMNS = [
    "loan_id", "Customer_ID", "loan_start_date", "tenure", "installment_num", "loan_amt", "due_amt",
    "paid_amt", "overdue_amt", "balance", "snapshot_date", "mob", "installments_missed",
    "first_missed_date", "dpd",
]
_CLICK_TYPES = {f: "float" for f in CLICKS}
_FIN_NUMBERS = list(fixed.FINANCIAL_NUMERIC_TYPES)
_FIN_KEPT = [
    *_FIN_NUMBERS, "Payment_of_Min_Amount", "Credit_History_Age_months", "Payment_Behaviour_encoded",
    *_MIXES, *_KINDS,
]
_RATIOS = {
    "emi_to_income": "f.Total_EMI_per_month::double / nullif(f.Monthly_Inhand_Salary::double + 1, 0)",
    "debt_to_income": "f.Outstanding_Debt::double / nullif(f.Annual_Income::double + 1, 0)",
    "debt_per_loan": "f.Outstanding_Debt::double / nullif(f.Num_of_Loan::double + 1, 0)",
    "util_per_card": "f.Credit_Utilization_Ratio::double / nullif(f.Num_Credit_Card::double + 1, 0)",
}
_LAGS = {
    "financials_lag_days": "cast(date_diff('day', f.snapshot_date, l.snapshot_date) as int)",
    "attributes_lag_days": "cast(date_diff('day', a.snapshot_date, l.snapshot_date) as int)",
}


def _assembled(mode: str) -> str:
    delay = "l.installments_missed" if mode == "asof" else "f.Num_of_Delayed_Payment"
    ratios = {**_RATIOS, "delay_frequency": f"{delay}::double / nullif(l.mob::double + 1, 0)"}
    derived = {**ratios, **(_LAGS if mode == "asof" else {})}
    match = "asof left join {t} {a} on l.Customer_ID = {a}.Customer_ID and l.snapshot_date >= {a}.snapshot_date"
    if mode == "exact":
        match = "left join {t} {a} on l.Customer_ID = {a}.Customer_ID and l.snapshot_date = {a}.snapshot_date"
    fin = {n: t for n, t in fixed.FINANCIAL_NUMERIC_TYPES.items() if t == "float"}
    return f"""
select {_wide("l.", _LOAN_COLUMNS, _LOAN_TYPES)},
       cast(date_diff('day', l.loan_start_date, l.snapshot_date) as int) as loan_age_days,
       {_wide("c.", CLICKS, _CLICK_TYPES)}, {_wide("f.", _FIN_KEPT, fin)},
       a.Age as Age, a.SSN as SSN, a.Occupation as Occupation,
       {", ".join(f"{e} as {n}" for n, e in derived.items())}
from loans l
     left join clicks c on l.Customer_ID = c.Customer_ID and l.snapshot_date = c.snapshot_date
     {match.format(t="encoded", a="f")}
     {match.format(t="attr", a="a")}"""


LAYERS["assembled_asof"] = _assembled("asof")
LAYERS["assembled_exact"] = _assembled("exact")
LAYERS["assembled_collapsed"] = """
select * from assembled_asof
qualify row_number() over (partition by Customer_ID, snapshot_date order by loan_id) = 1"""

_WHOLE = {"tenure", "installment_num", "mob", "loan_age_days", "Age", "Credit_History_Age_months",
          "Payment_Behaviour_encoded", *_MIXES, *_KINDS,
          *[n for n, t in fixed.FINANCIAL_NUMERIC_TYPES.items() if t == "int"]}


_IMPUTED = [
    "tenure", "installment_num", "loan_amt", "due_amt", "mob", "loan_age_days", *CLICKS,
    *[n for n in _FIN_KEPT if n != "Payment_of_Min_Amount"], "Age", *_RATIOS, "delay_frequency",
]


def _imputed(table: str, mode: str = "asof", fit_where: str = "") -> str:
    names = _IMPUTED
    lags = ["financials_lag_days", "attributes_lag_days"] if mode == "asof" else []
    kept = [n for n in _LOAN_COLUMNS if n not in names] + ["Payment_of_Min_Amount", "SSN", "Occupation", *lags]
    filled = [
        f"coalesce({n}, cast(trunc(m_{n}) as int)) as {n}" if n in _WHOLE else f"coalesce({n}, m_{n}) as {n}"
        for n in names
    ]
    return f"""
select {", ".join(kept)}, {", ".join(filled)}
from {table}, (select {", ".join(f"quantile_disc({n}, 0.5) as m_{n}" for n in names)} from {table} {fit_where})"""


def _summary(table: str, names, places: int = 2) -> str:
    parts = [
        f"""select '{n}' as column_name, count({n}) as count, round_even(avg({n}::double), {places}) as mean,
       round_even(stddev_samp({n}::double), {places}) as std, round_even(min({n})::double, {places}) as min,
       round_even(quantile_cont({n}::double, 0.25), {places}) as q25,
       round_even(quantile_cont({n}::double, 0.5), {places}) as q50,
       round_even(quantile_cont({n}::double, 0.75), {places}) as q75,
       round_even(max({n})::double, {places}) as max from {table}"""
        for n in names
    ]
    return "\nunion all\n".join(parts)


def _histogram(value: str, table: str, bins: int) -> str:
    return f"""
with v as (select cast({value} as double) as v from {table} where {value} is not null),
ends as (select min(v) - (case when min(v) = max(v) then 0.5::double else 0::double end) as low,
                max(v) + (case when min(v) = max(v) then 0.5::double else 0::double end) as high from v),
edges as (select b as bin, low + b * ((high - low) / {bins}) as lower_edge,
                 case when b = {bins - 1} then high else low + (b + 1) * ((high - low) / {bins}) end
                   as upper_edge
          from ends, unnest(range(0, {bins})) as t(b))
select bin, lower_edge, upper_edge, count(v) as row_count
from edges left join v
     on v >= lower_edge and (v < upper_edge or (bin = {bins - 1} and v <= upper_edge))
group by all"""


def _quantiles(table: str, names, probability: float) -> str:
    return " union all ".join(
        f"select '{n}' as column_name, {probability}::double as probability,"
        f" quantile_cont({n}::double, {probability}) as quantile from {table}"
        for n in names
    )


_POSITIVE = "(select * from retail_tx where Quantity > 0 and UnitPrice > 0)"
_FIN_FLOATS = {n: t for n, t in fixed.FINANCIAL_NUMERIC_TYPES.items() if t == "float"}
_RAW_NAMES = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
_CARDINAL = ["InvoiceNo", "StockCode", "Description", "CustomerID", "Country"]

_STORE = _imputed("assembled_asof")

QUERIES = {
    "loan_silver": f"select {_wide('', _LOAN_COLUMNS, _LOAN_TYPES)} from loans",
    "financials_silver": f"""select Customer_ID, snapshot_date, {", ".join(_TEXTS)},
       {_wide("", _FIN_NUMBERS, _FIN_FLOATS)} from fin""",
    "attributes_silver": "select * from attr",
    "clickstream_silver": f"select Customer_ID, snapshot_date, {_wide('', CLICKS, _CLICK_TYPES)} from clicks",
    "label_store": """select loan_id, Customer_ID, cast(case when dpd >= 30 then 1 else 0 end as int) as label,
       '30dpd_6mob' as label_def, snapshot_date from loans where mob = 6""",
    "history_age": f"""select Customer_ID, snapshot_date, Credit_History_Age,
       {_HISTORY} as Credit_History_Age_months from fin""",
    "payment_ordinal": f"""select Customer_ID, snapshot_date, Payment_Behaviour,
       {_ORDINAL} as Payment_Behaviour_encoded from fin""",
    "credit_mix_onehot": f"select Customer_ID, snapshot_date, Credit_Mix, {', '.join(_MIX_FLAGS)} from fin",
    "loan_type_flags": f"select Customer_ID, snapshot_date, Type_of_Loan, {', '.join(_KIND_FLAGS)} from fin",
    "loan_type_tokens": """select loan_type, count(*) as row_count
       from (select unnest(regexp_split_to_array(regexp_replace(Type_of_Loan, ' and ', ',', 'g'), ',\\s*'))
               as loan_type from fin)
       where loan_type <> '' group by loan_type""",
    "pit_join": """select loan_id, l.Customer_ID, l.snapshot_date, cast(fe_1 as double) as fe_1,
       cast(fe_10 as double) as fe_10, cast(fe_20 as double) as fe_20
       from loans l left join clicks c on l.Customer_ID = c.Customer_ID and l.snapshot_date = c.snapshot_date""",
    "exact_join": """select loan_id, l.snapshot_date, cast(fe_1 as double) as fe_1,
       cast(Annual_Income as double) as Annual_Income, Age, Occupation
       from loans l
       left join fin f on l.Customer_ID = f.Customer_ID and l.snapshot_date = f.snapshot_date
       left join clicks c on l.Customer_ID = c.Customer_ID and l.snapshot_date = c.snapshot_date
       left join attr a on l.Customer_ID = a.Customer_ID and l.snapshot_date = a.snapshot_date""",
    "asof_financials": f"""select loan_id, l.Customer_ID, l.snapshot_date,
       cast(Annual_Income as double) as Annual_Income, Num_of_Loan, Credit_Mix,
       cast(Monthly_Balance as double) as Monthly_Balance, {_LAGS["financials_lag_days"]} as financials_lag_days
       from loans l asof left join fin f on l.Customer_ID = f.Customer_ID and l.snapshot_date >= f.snapshot_date""",
    "asof_attributes": f"""select loan_id, l.Customer_ID, l.snapshot_date, Age, SSN, Occupation,
       {_LAGS["attributes_lag_days"]} as attributes_lag_days
       from loans l asof left join attr a on l.Customer_ID = a.Customer_ID and l.snapshot_date >= a.snapshot_date""",
    "asof_collapsed": f"""select loan_id, l.Customer_ID, l.snapshot_date,
       cast(Annual_Income as double) as Annual_Income, {_LAGS["financials_lag_days"]} as financials_lag_days
       from loans l left join fin f on l.Customer_ID = f.Customer_ID and f.snapshot_date <= l.snapshot_date
       qualify row_number() over (partition by l.Customer_ID, l.snapshot_date
                                  order by loan_id, f.snapshot_date desc) = 1""",
    "asof_match_rate": """select count(*) as total_rows, count(f.snapshot_date) as financials_matched,
       count(a.snapshot_date) as attributes_matched
       from loans l asof left join fin f on l.Customer_ID = f.Customer_ID and l.snapshot_date >= f.snapshot_date
       asof left join attr a on l.Customer_ID = a.Customer_ID and l.snapshot_date >= a.snapshot_date""",
    "loan_ratios": f"""select loan_id, snapshot_date, loan_age_days, {", ".join([*_RATIOS, "delay_frequency"])}
       from assembled_asof""",
    "feature_store_asof": _STORE,
    "feature_store_exact": _imputed("assembled_exact", "exact"),
    "feature_store_collapsed": _imputed("assembled_collapsed"),
    "feature_store_fit_period": _imputed("assembled_asof", fit_where="where snapshot_date <= date '1998-12-31'"),
    "median_impute": """
with gaps as (select c_custkey, case when c_custkey % 7 <> 0 then c_acctbal end as c_acctbal,
                     case when c_custkey % 5 <> 0 then c_nationkey end as c_nationkey from customer)
select c_custkey, coalesce(c_acctbal, (select quantile_disc(c_acctbal, 0.5) from gaps)) as c_acctbal,
       coalesce(c_nationkey, (select quantile_disc(c_nationkey, 0.5) from gaps)) as c_nationkey,
       cast(null as double) as never_known
from gaps""",
    "lineitem_medians": " union all ".join(
        f"select '{n}' as column_name, cast(quantile_disc({n}, 0.5) as double) as median from lineitem"
        for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")
    ),
    "pipeline_labels": """select loan_id, Customer_ID, cast(case when dpd >= 30 then 1 else 0 end as int) as label,
       '30dpd_6mob' as label_def, snapshot_date from loans where mob = 6""",
    "pipeline_features": _STORE,
    "relabel_rerun": """select loan_id, Customer_ID, cast(case when dpd >= 30 then 1 else 0 end as int) as label,
       '30dpd_0mob' as label_def, snapshot_date from loans where mob = 0""",
    "silver_rerun": """select Customer_ID, snapshot_date from attr
       where snapshot_date <> date '1995-06-01'""",
    "calendar_backfill": """select loan_id, installment_num, snapshot_date from loans
       where snapshot_date between date '1997-05-01' and date '1998-02-10'""",
    "calendar_months": """select cast(unnest(generate_series(timestamp '1997-05-01', timestamp '1998-02-10',
       interval 1 month)) as date) as snapshot_date""",
    "quoted_transactions": """select InvoiceNo, StockCode, Description || ', "' || StockCode || '"' || chr(10) || ' end'
         as Description, Quantity, Country from retail_tx""",
    "metadata_file": "select * from metadata",
    "raw_layer": """select Customer_ID, Name, Age, SSN, Occupation, cast(snapshot_date as date) as snapshot_date
       from attributes_raw""",
    "transactions_file": "select * from countries",
    "snapshot_dates": "select distinct snapshot_date from loan_daily",
    "month_calendar": """select cast(unnest(generate_series(date_trunc('month', min(snapshot_date)),
       max(snapshot_date)::timestamp, interval 1 month)) as date) as snapshot_date from loan_daily""",
    "rows_per_snapshot": "select snapshot_date, count(*) as row_count from loans group by snapshot_date",
    "snapshot_slice": f"""select {_wide("", _LOAN_COLUMNS, _LOAN_TYPES)} from loans
       where snapshot_date = date '1998-06-01'""",
    "null_profile": "select * from ("
    + " union all ".join(
        f"select '{n}' as column_name, count(*) - count({n}) as missing_count,"
        f" round_even((count(*) - count({n}))::double / count(*)::double * 100, 2) as missing_pct from retail_tx"
        for n in _RAW_NAMES
    )
    + ") where missing_count > 0",
    "column_cardinality": " union all ".join(
        f"select '{n}' as column_name, count(distinct {n}) as distinct_count from retail_tx" for n in _CARDINAL
    ),
    "numeric_summary": _summary("retail_tx", ("Quantity", "UnitPrice", "CustomerID")),
    "anomaly_counts": """select count(*) filter (starts_with(InvoiceNo, 'C')) as cancelled_rows,
       count(*) filter (Quantity < 0) as negative_quantity_rows,
       count(*) filter (UnitPrice < 0) as negative_price_rows,
       count(*) filter (UnitPrice = 0) as zero_price_rows,
       count(*) filter (upper(StockCode) in ('POST', 'D', 'DOT', 'M', 'S', 'AMAZONFEE', 'BANK CHARGES'))
         as non_product_rows,
       round_even(count(*) filter (starts_with(InvoiceNo, 'C'))::double / count(*)::double * 100, 2)
         as cancelled_pct
       from retail_tx""",
    "date_range": """select cast(min(InvoiceDate) as date) as first_date, cast(max(InvoiceDate) as date) as last_date
       from retail_tx""",
    "clean_size": "select count(*) as row_count, count(distinct CustomerID) as customers from sales",
    "upper_quantiles": _quantiles(_POSITIVE, ("Quantity", "UnitPrice"), 0.99),
    "column_maxima": "select max(Quantity) as max_Quantity, max(UnitPrice) as max_UnitPrice from retail_tx",
    "histogram_quantity": _histogram("least(Quantity, 200)", _POSITIVE, 60),
    "histogram_price": _histogram("least(UnitPrice, 30)", _POSITIVE, 60),
    "monthly_revenue": """select strftime(InvoiceDate, '%Y-%m') as YearMonth,
       cast(sum(Revenue) as double) as Revenue, count(distinct InvoiceNo) as Orders,
       count(distinct CustomerID) as Customers from sales group by 1""",
    "peak_month": """select strftime(InvoiceDate, '%Y-%m') as YearMonth, cast(sum(Revenue) as double) as Revenue
       from sales group by 1 order by sum(Revenue) desc, 1 limit 1""",
    "orders_by_hour": """select cast(hour(InvoiceDate) as int) as Hour, count(distinct InvoiceNo) as Orders
       from sales group by 1""",
    "orders_by_weekday": """
with week as (select unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'])
                as DayOfWeek, unnest(range(0, 7)) as day_number)
select cast(day_number as int) as day_number, DayOfWeek, count(distinct InvoiceNo) as Orders
from week left join sales on dayname(InvoiceDate) = DayOfWeek group by all""",
    "country_revenue": "select * from countries",
    "top_countries": "select * from countries order by Revenue desc, Country limit 10",
    "home_vs_abroad": """
select case when Country = 'United Kingdom' then Country else 'International' end as Market,
       cast(sum(Revenue) as double) as Revenue,
       round_even(cast(sum(Revenue) as double)
         / (select cast(sum(Revenue) as double) from sales where Country is not null) * 100, 1) as Revenue_pct
from sales where Country is not null group by 1""",
    "customer_summary": "select * exclude (exact_revenue) from customers",
    "customer_statistics": _summary("customers", ("Orders", "Revenue", "AvgOrderValue", "TenureDays")),
    "order_count_shares": """
select count(*) filter (Orders = 1) as single_order_customers,
       round_even(count(*) filter (Orders = 1)::double / count(*)::double * 100, 1) as single_order_pct,
       count(*) filter (Orders >= 5) as frequent_customers,
       round_even(count(*) filter (Orders >= 5)::double / count(*)::double * 100, 1) as frequent_pct
from customers""",
    "histogram_orders": _histogram("least(Orders, 30)", "customers", 30),
    "pareto_customers": "select * from pareto",
    "pareto_top_share": "select max(CumRevPct) as top_revenue_pct from pareto where CustPct <= 20",
    "top_products": """select * replace (cast(Revenue as double) as Revenue) from products
       order by products.Revenue desc, StockCode, Description limit 15""",
    "top100_share": """
with best as (select Revenue from products order by Revenue desc, StockCode, Description limit 100)
select (select count(*) from products) as products,
       round_even((select cast(sum(Revenue) as double) from best)
         / (select cast(sum(Revenue) as double) from products) * 100, 1) as top_revenue_pct""",
    "product_revenue": "select * replace (cast(Revenue as double) as Revenue) from products",
    "product_long_tail": "select * from long_tail",
    "long_tail_80": """select count(*) filter (CumRevPct <= 80) as products_within, count(*) as products
       from long_tail""",
    "basket_summary": "select * from baskets",
    "basket_statistics": _summary("baskets", ("Revenue", "Items", "SKUs")),
    "histogram_basket": _histogram(
        "least(Revenue, (select quantile_cont(Revenue, 0.99) from baskets))", "baskets", 50
    ),
    "histogram_basket_items": _histogram(
        "least(Items, (select quantile_cont(Items::double, 0.99) from baskets))", "baskets", 50
    ),
    "histogram_basket_skus": _histogram(
        "least(SKUs, (select quantile_cont(SKUs::double, 0.99) from baskets))", "baskets", 50
    ),
    "rfm_base": "select * from rfm",
    "rfm_scores": "select * from scores",
    "rfm_segments": """select Segment, count(*) as Count, round_even(avg(Recency), 1) as Avg_Recency,
       round_even(avg(Frequency), 1) as Avg_Frequency, round_even(avg(Monetary), 1) as Avg_Monetary
       from scores group by Segment""",
    "histogram_recency": _histogram("Recency", "rfm", 50),
    "histogram_frequency": _histogram("least(Frequency, 30)", "rfm", 30),
    "histogram_monetary": _histogram("least(Monetary, 10000)", "rfm", 50),
    "churn_label": "select * from churned",
    "churn_rate": """select count(*) as customers, cast(sum(Churned) as bigint) as churned,
       round_even(sum(Churned)::double / count(*)::double * 100, 1) as churned_pct,
       cast(count(*) - sum(Churned) as bigint) as retained,
       round_even((count(*) - sum(Churned))::double / count(*)::double * 100, 1) as retained_pct from churned""",
    "customer_stats": """select CustomerID, total_revenue, order_count, first_order, primary_country from tiers""",
    "customer_tiers": "select CustomerID, company_size, is_vip from tiers",
    "customer_region": "select CustomerID, primary_country, region from tiers",
    "account_manager": """select customer_id as CustomerID, company_size, account_manager from metadata""",
    "weighted_assignment": "select customer_id, vertical, onboard_channel, payment_terms_days from metadata",
    "noisy_numbers": "select customer_id, credit_limit_gbp, years_in_business from metadata",
    "customer_metadata": "select * from metadata",
    "metadata_preview": "select * from metadata order by customer_id limit 5",
    "vertical_distribution": "select vertical, count(*) as row_count from metadata group by vertical",
    "region_distribution": "select region, count(*) as row_count from metadata group by region",
    "size_distribution": "select company_size, count(*) as row_count from metadata group by company_size",
    "vip_share": """select cast(sum(is_vip) as bigint) as vip_customers,
       round_even(avg(is_vip) * 100, 1) as vip_pct from metadata""",
}
QUERIES["credit_limit_by_size"] = """
select company_size, count(credit_limit_gbp) as count, round_even(avg(credit_limit_gbp), 0) as mean,
       round_even(stddev_samp(credit_limit_gbp), 0) as std, cast(min(credit_limit_gbp) as double) as min,
       round_even(quantile_cont(credit_limit_gbp::double, 0.25), 0) as q25,
       round_even(quantile_cont(credit_limit_gbp::double, 0.5), 0) as q50,
       round_even(quantile_cont(credit_limit_gbp::double, 0.75), 0) as q75,
       cast(max(credit_limit_gbp) as double) as max
from metadata group by company_size"""

# every median from a sketch has to lie within its bound
QUERIES["sketch_medians"] = f"""
select column_name, n_values, true as within_error
from (unpivot (select {", ".join(f"count({n}) as {n}" for n in _IMPUTED)} from assembled_asof
               where snapshot_date <= date '1998-12-31')
      on columns(*) into name column_name value n_values)"""

QUERIES["feature_store_discovered"] = QUERIES["feature_store_asof"]


def _audited(layer: str, name: str, table: str, where: str = "true", matched: tuple[str, str] | None = None) -> str:
    counts = [f"count({c})" for c in matched] if matched else ["cast(null as bigint)"] * 2
    return f"""select '{layer}' as layer, '{name}' as table_name, cast(snapshot_date as date) as snapshot_date,
       count(*) as row_count, {counts[0]} as financials_matched, {counts[1]} as attributes_matched
from {table} where {where} group by all"""


QUERIES["pipeline_audit"] = "\nunion all\n".join([
    _audited("bronze", "loan_daily", "loan_daily"),
    _audited("bronze", "financials", "financials_raw", "snapshot_date <> ''"),
    _audited("bronze", "attributes", "attributes_raw", "snapshot_date <> ''"),
    _audited("bronze", "clickstream", "clickstream_raw", "snapshot_date <> ''"),
    _audited("silver", "loan_daily", "loans"),
    _audited("silver", "financials", "fin", "snapshot_date is not null"),
    _audited("silver", "attributes", "attr", "snapshot_date is not null"),
    _audited("silver", "clickstream", "clicks", "snapshot_date is not null"),
    _audited("gold", "label_store", "loans", "mob = 6"),
    _audited("gold", "feature_store", "assembled_asof", matched=("financials_lag_days", "attributes_lag_days")),
])

QUERIES["month_from_states"] = "select * from assembled_asof where snapshot_date = date '1998-06-01'"

QUERIES["price_by_part_group"] = """
with v as (select case when l_partkey % 3 = 0 then 'thirds' else 'g' || (l_partkey % 20) end as part_group,
                  l_extendedprice * (1 - l_discount) as net_price from lineitem)
select part_group, count(net_price) as count, round_even(avg(net_price), 2) as mean,
       round_even(stddev_samp(net_price), 2) as std, round_even(min(net_price), 2) as min,
       round_even(quantile_cont(net_price, 0.25), 2) as q25, round_even(quantile_cont(net_price, 0.5), 2) as q50,
       round_even(quantile_cont(net_price, 0.75), 2) as q75, round_even(max(net_price), 2) as max
from v group by part_group"""

_PER_PERIOD = """select '{level}' as level, {period} as period, '{name}' as column_name,
       count(distinct {name}) as distinct_count from retail_tx group by all having count({name}) > 0"""
QUERIES["distinct_by_period"] = "\nunion all\n".join(
    _PER_PERIOD.format(level=level, period=period, name=name)
    for level, period in (
        ("month", "cast(date_trunc('month', InvoiceDate) as date)"),
        ("quarter", "cast(date_trunc('quarter', InvoiceDate) as date)"),
        ("whole", "cast(null as date)"),
    )
    for name in ("CustomerID", "StockCode", "Country", "InvoiceNo")
)

_PARTS = {**VIEWS, **LAYERS}


def _needed(text: str, found: list[str]) -> list[str]:
    """Names of the definitions a text uses, those that others build on first."""
    for name in _PARTS:
        if name not in found and re.search(rf"\b(from|join|,)\s*\(?\s*{name}\b", text):
            _needed(_PARTS[name], found)
            if name not in found:
                found.append(name)
    return found


def complete(text: str) -> str:
    """A query with its definitions in front."""
    heads = [f"{name} as ({_PARTS[name]})" for name in _needed(text, [])]
    if not heads:
        return text
    return f"with {', '.join(heads)}\nselect * from ({text})"


def sql() -> dict[str, str]:
    return {name: complete(text) for name, text in QUERIES.items()}
