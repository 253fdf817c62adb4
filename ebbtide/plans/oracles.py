"""Plain SQL for the registered queries, written from the definitions rather than from
the Spark plans. It runs on the raw tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

_ADDONS = (
    ("OnlineSecurity", 17, 13, 4),
    ("OnlineBackup", 19, 17, 6),
    ("DeviceProtection", 23, 19, 7),
    ("TechSupport", 29, 23, 8),
    ("StreamingTV", 31, 29, 12),
    ("StreamingMovies", 41, 31, 13),
)
_ADDON_SQL = ",\n".join(
    f"CASE WHEN net = 'No' THEN 'No internet service' WHEN (k*{a}) % {m} < {c} THEN 'Yes' ELSE 'No' END AS {n}"
    for n, a, m, c in _ADDONS
)
_COLUMNS = (
    "customerID, gender, SeniorCitizen, Partner, Dependents, tenure, PhoneService, MultipleLines, InternetService, "
    "OnlineSecurity, OnlineBackup, DeviceProtection, TechSupport, StreamingTV, StreamingMovies, Contract, "
    "PaperlessBilling, PaymentMethod, MonthlyCharges, TotalCharges, Churn"
)

BASE = f"""
facts AS (
  SELECT o_custkey, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
         max(o_orderdate) AS last_order
  FROM orders GROUP BY o_custkey),
raw0 AS (
  SELECT c.c_custkey AS k, c.c_nationkey AS nat, c.c_mktsegment AS seg, c.c_name,
         coalesce(f.n_orders, 0) AS n_orders, coalesce(f.n_f, 0) AS n_f, f.last_order,
         CASE WHEN c.c_nationkey % 5 < 2 THEN 'Fiber optic' WHEN c.c_nationkey % 5 < 4 THEN 'DSL' ELSE 'No' END AS net,
         CASE WHEN c.c_mktsegment IN ('AUTOMOBILE','BUILDING','HOUSEHOLD') THEN 'Month-to-month'
              WHEN c.c_mktsegment = 'FURNITURE' THEN 'One year' ELSE 'Two year' END AS con,
         CAST((c.c_custkey*37 + c.c_nationkey*11) % 73 AS INT) AS ten,
         CAST(1835 + (c.c_custkey*7919) % 10040 AS DOUBLE) / 100 AS mc
  FROM customer c LEFT JOIN facts f ON f.o_custkey = c.c_custkey),
subk AS (
  SELECT k, last_order, c_name AS customerID,
    CASE WHEN k % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END AS SeniorCitizen,
    CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
    CASE WHEN k % 7 < 2 THEN 'Yes' ELSE 'No' END AS Dependents,
    ten AS tenure,
    CASE WHEN k % 10 = 0 THEN 'No' ELSE 'Yes' END AS PhoneService,
    CASE WHEN k % 10 = 0 THEN 'No phone service' WHEN (k*13) % 11 < 5 THEN 'Yes' ELSE 'No' END AS MultipleLines,
    net AS InternetService,
    {_ADDON_SQL},
    con AS Contract,
    CASE WHEN (k*43) % 5 < 3 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
    CASE (k*47 + n_orders) % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
    mc AS MonthlyCharges,
    CASE WHEN ten = 0 THEN ' ' ELSE CAST(CAST(mc*ten AS DECIMAL(12,2)) AS VARCHAR) END AS TotalCharges,
    CASE WHEN (k*53) % 100 < CASE con WHEN 'Month-to-month' THEN 40 WHEN 'One year' THEN 12 ELSE 4 END
           + CASE WHEN net = 'Fiber optic' THEN 10 ELSE 0 END - CASE WHEN ten > 36 THEN 8 ELSE 0 END
           + CASE WHEN n_f > n_orders / 2.0 THEN 4 ELSE 0 END THEN 'Yes' ELSE 'No' END AS Churn
  FROM raw0),
sub AS (SELECT {_COLUMNS} FROM subk)"""

CLEAN = """
num AS (SELECT * REPLACE (TRY_CAST(TotalCharges AS DOUBLE) AS TotalCharges) FROM sub),
cl AS (
  SELECT * REPLACE (CASE SeniorCitizen WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS SeniorCitizen,
                    CAST(CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS INT) AS Churn)
  FROM num WHERE TotalCharges IS NOT NULL)"""

_BUCKET = (
    "CASE WHEN tenure > 60 THEN '5yr+' WHEN tenure > 36 THEN '3-5yr' WHEN tenure > 24 THEN '2-3yr' "
    "WHEN tenure > 12 THEN '1-2yr' WHEN tenure > 6 THEN '6-12mo' WHEN tenure > 0 THEN '0-6mo' END"
)
_GROUP = (
    "CASE WHEN tenure > 72 THEN NULL WHEN tenure > 60 THEN '61-72' WHEN tenure > 36 THEN '37-60' "
    "WHEN tenure > 24 THEN '25-36' WHEN tenure > 12 THEN '13-24' WHEN tenure > 0 THEN '0-12' END"
)
_SERVICES = (
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
)
_COUNT = "CAST(" + " + ".join(f"(CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END)" for c in _SERVICES) + " AS INT)"
_COST = f"MonthlyCharges / ({_COUNT} + 1)"
_M2M = "(CASE WHEN Contract = 'Month-to-month' THEN 1 ELSE 0 END)"
_CT = f"CAST(tenure * {_M2M} AS INT)"
_NOSEC = "CAST(CASE WHEN OnlineSecurity = 'No' AND OnlineBackup = 'No' AND DeviceProtection = 'No' THEN 1 ELSE 0 END AS INT)"
_RISKPAY = "CAST(CASE WHEN PaymentMethod = 'Electronic check' AND Contract = 'Month-to-month' THEN 1 ELSE 0 END AS INT)"

FEATURES = f"""
feat AS (
  SELECT *, TotalCharges / (tenure + 1) AS AvgMonthlySpend, MonthlyCharges / (tenure + 1) AS Revenue_per_Tenure,
    {_BUCKET} AS Tenure_Bucket, {_COUNT} AS ServiceCount, {_COST} AS Cost_per_Service,
    InternetService <> 'No' AS HasInternetService, PhoneService = 'Yes' AS HasPhoneService,
    Contract = 'Month-to-month' AS IsMonthToMonth, {_CT} AS Contract_Tenure, {_NOSEC} AS NoSecurity,
    {_RISKPAY} AS HighRiskPayment,
    CAST(CASE WHEN SeniorCitizen = 'Yes' AND MonthlyCharges > (SELECT median(MonthlyCharges) FROM cl) THEN 1 ELSE 0 END AS INT)
      AS Senior_HighCharge
  FROM cl)"""

_LEVELS = {
    "gender": ("Female", "Male"),
    "SeniorCitizen": ("No", "Yes"),
    "Partner": ("No", "Yes"),
    "Dependents": ("No", "Yes"),
    "PhoneService": ("No", "Yes"),
    "MultipleLines": ("No", "No phone service", "Yes"),
    "InternetService": ("DSL", "Fiber optic", "No"),
    **{n: ("No", "No internet service", "Yes") for n, *_ in _ADDONS},
    "Contract": ("Month-to-month", "One year", "Two year"),
    "PaperlessBilling": ("No", "Yes"),
    "PaymentMethod": ("Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"),
    "Tenure_Bucket": ("0-6mo", "6-12mo", "1-2yr", "2-3yr", "3-5yr", "5yr+"),
}
_PLAIN = (
    "tenure", "MonthlyCharges", "TotalCharges", "AvgMonthlySpend", "Revenue_per_Tenure", "ServiceCount",
    "Cost_per_Service", "HasInternetService", "HasPhoneService", "IsMonthToMonth", "Contract_Tenure", "NoSecurity",
    "HighRiskPayment", "Senior_HighCharge",
)
_REAL = {"MonthlyCharges", "TotalCharges", "AvgMonthlySpend", "Revenue_per_Tenure", "Cost_per_Service"}


def r(expression: str, digits: int = 6) -> str:
    """Rounded, and never a negative zero."""
    return f"(round({expression}, {digits}) + 0.0::DOUBLE)"


def _flag(column: str, level: str) -> str:
    return f"CAST(CASE WHEN {column} = '{level}' THEN 1 ELSE 0 END AS INT)"


_DUMMIES = {f"{c}_{v}": _flag(c, v) for c, levels in _LEVELS.items() for v in levels[1:]}
_PLAIN_SQL = {c: (r(c) if c in _REAL else c) for c in _PLAIN}

# The scorer: log-odds as a weighted sum, then the logistic function.
_TERMS = {
    "tenure": ("tenure", -0.03),
    "MonthlyCharges": ("MonthlyCharges", 0.01),
    "Contract_Month-to-month": (_flag("Contract", "Month-to-month"), 1.25),
    "Contract_Two year": (_flag("Contract", "Two year"), -0.75),
    "InternetService_Fiber optic": (_flag("InternetService", "Fiber optic"), 0.5),
    "OnlineSecurity_No": (_flag("OnlineSecurity", "No"), 0.25),
    "TechSupport_No": (_flag("TechSupport", "No"), 0.2),
    "PaymentMethod_Electronic check": (_flag("PaymentMethod", "Electronic check"), 0.3),
    "PaperlessBilling_Yes": (_flag("PaperlessBilling", "Yes"), 0.15),
    "SeniorCitizen": ("SeniorCitizen", 0.2),
    "Partner_Yes": (_flag("Partner", "Yes"), -0.1),
    "StreamingTV_Yes": (_flag("StreamingTV", "Yes"), 0.05),
}


def _probability(intercept: float, terms: dict[str, tuple[str, float]]) -> str:
    z = f"CAST({intercept} AS DOUBLE)"
    for sql, weight in terms.values():
        z = f"({z} + CAST({sql} AS DOUBLE) * CAST({weight} AS DOUBLE))"
    return r(f"1 / (1 + exp(-{z}))")


P_MAIN = _probability(-1.5, _TERMS)
_MODELS = (
    ("main", P_MAIN),
    ("tenure", _probability(0.25, {"tenure": ("tenure", -0.04)})),
    ("contract", _probability(-0.25, {c: _TERMS[c] for c in ("Contract_Month-to-month", "Contract_Two year")})),
    ("charge", _probability(-2.0, {"MonthlyCharges": ("MonthlyCharges", 0.025)})),
)
SCORED = f"""
sc AS (SELECT customerID, {P_MAIN} AS p, CASE Churn WHEN 'Yes' THEN 1 ELSE 0 END AS y FROM sub)"""


def put(name: str, body: str, *parts: str) -> None:
    SQL[name] = "WITH " + ",".join((BASE, *parts)) + "\n" + body


_LEVEL = "CASE WHEN {p} > 0.7 THEN 'High' WHEN {p} > 0.3 THEN 'Medium' ELSE 'Low' END"
_HASH = "md5(customerID || '|42')"

# --- sources and sinks, projections -----------------------------------------------------
put("scan_customers", "SELECT * FROM sub")

REQUESTS = """
req AS (
  SELECT * EXCLUDE (k, last_order, Churn) REPLACE (
    CASE WHEN k % 53 = 1 THEN NULL ELSE Contract END AS Contract,
    CASE WHEN k % 59 = 2 THEN 'abc' WHEN k % 61 = 3 THEN '-1' ELSE CAST(tenure AS VARCHAR) END AS tenure,
    CASE WHEN k % 67 = 4 THEN '0' ELSE CAST(MonthlyCharges AS VARCHAR) END AS MonthlyCharges,
    CASE WHEN k % 71 = 5 THEN 'Cable' ELSE InternetService END AS InternetService,
    CASE WHEN k % 73 = 6 THEN NULL ELSE customerID END AS customerID)
  FROM subk)"""
put("scan_requests_json", "SELECT * FROM req", REQUESTS)

_BATCH = f"""SELECT customerID, p AS churn_probability, CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS INT) AS predicted_churn,
  {_LEVEL.format(p='p')} AS risk_level FROM sc"""
put("score_batch", _BATCH, SCORED)
put("write_predictions", _BATCH, SCORED)

put("coerce_numeric", "SELECT customerID, TotalCharges FROM num", CLEAN)
put("drop_incomplete", "SELECT customerID, tenure, TotalCharges FROM num WHERE TotalCharges IS NOT NULL", CLEAN)
put("recode_senior", "SELECT customerID, CASE SeniorCitizen WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS SeniorCitizen FROM sub")
put("recode_target", "SELECT customerID, CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS Churn FROM sub")
put("target_to_label", "SELECT customerID, Churn FROM sub")
put("clean_customers", "SELECT * FROM cl", CLEAN)
put("drop_columns", "SELECT * EXCLUDE (customerID, Churn) FROM cl", CLEAN)
put(
    "spend_ratios",
    f"SELECT customerID, {r('TotalCharges / (tenure + 1)')} AS AvgMonthlySpend, {r('MonthlyCharges / (tenure + 1)')} AS Revenue_per_Tenure FROM cl",
    CLEAN,
)
put(
    "tenure_bucket",
    f"""SELECT customerID, {_BUCKET} AS Tenure_Bucket, CASE WHEN tenure > 60 THEN 5 WHEN tenure > 36 THEN 4 WHEN tenure > 24 THEN 3
    WHEN tenure > 12 THEN 2 WHEN tenure > 6 THEN 1 WHEN tenure > 0 THEN 0 END AS position FROM sub""",
)
_GROUP_RANK = "CASE WHEN tenure > 72 THEN NULL WHEN tenure > 60 THEN 4 WHEN tenure > 36 THEN 3 WHEN tenure > 24 THEN 2 WHEN tenure > 12 THEN 1 WHEN tenure > 0 THEN 0 END"
put("tenure_group", f"SELECT customerID, {_GROUP} AS tenure_group, {_GROUP_RANK} AS position FROM sub")
put("service_count", f"SELECT customerID, {_COUNT} AS ServiceCount FROM sub")
put("cost_per_service", f"SELECT customerID, {r(_COST)} AS Cost_per_Service FROM sub")
put(
    "service_flags",
    "SELECT customerID, InternetService <> 'No' AS HasInternetService, PhoneService = 'Yes' AS HasPhoneService, Contract = 'Month-to-month' AS IsMonthToMonth FROM sub",
)
put("contract_tenure", f"SELECT customerID, {_CT} AS Contract_Tenure FROM sub")
put("no_security", f"SELECT customerID, {_NOSEC} AS NoSecurity FROM sub")
put("high_risk_payment", f"SELECT customerID, {_RISKPAY} AS HighRiskPayment FROM sub")
put(
    "senior_high_charge",
    "SELECT customerID, CAST(CASE WHEN SeniorCitizen = 1 AND MonthlyCharges > (SELECT median(MonthlyCharges) FROM sub) THEN 1 ELSE 0 END AS INT) AS Senior_HighCharge FROM sub",
)
put("median_charge", f"SELECT {r('median(MonthlyCharges)')} AS median_charge FROM sub")
_REPLACED = ", ".join(f"{r(c)} AS {c}" for c in sorted(_REAL))
put("create_features", f"SELECT * REPLACE ({_REPLACED}) FROM feat", CLEAN, FEATURES)
_FULL = {f"{c}_{v}": _flag(c, v) for c, levels in _LEVELS.items() for v in levels}
_IMPORTANT = (
    "Contract_Month-to-month", "tenure", "TotalCharges", "MonthlyCharges", "InternetService_Fiber optic",
    "PaymentMethod_Electronic check", "OnlineSecurity_No", "TechSupport_No", "PaperlessBilling_Yes",
    "Contract_Two year", "Revenue_per_Tenure", "ServiceCount", "NoSecurity", "HighRiskPayment", "Contract_Tenure",
)
put(
    "select_important",
    "SELECT customerID, " + ", ".join(f'{_FULL.get(c) or _PLAIN_SQL[c]} AS "{c}"' for c in _IMPORTANT) + " FROM feat",
    CLEAN,
    FEATURES,
)
_CODED = ", ".join(f'{sql} AS "{c}"' for c, sql in {**_PLAIN_SQL, **_DUMMIES}.items())
put("one_hot_drop_first", f"SELECT customerID, {_CODED} FROM feat", CLEAN, FEATURES)
_ALIGNED = {c: (c if c in ("tenure", "MonthlyCharges", "TotalCharges") else "0") for c in _PLAIN} | {
    n: ("0" if n.startswith(("SeniorCitizen", "Tenure_Bucket")) else sql) for n, sql in _DUMMIES.items()
}
put(
    "one_hot_align",
    "SELECT customerID, " + ", ".join(f'{sql} AS "{c}"' for c, sql in _ALIGNED.items()) + " FROM num",
    CLEAN,
)
_ALL46 = {c: f"CAST({c} AS DOUBLE)" for c in _PLAIN} | {c: f"CAST({sql} AS DOUBLE)" for c, sql in _DUMMIES.items()}
_NAMED = ", ".join(f'{sql} AS "{c}"' for c, sql in _ALL46.items())
_STATS = ", ".join(f'avg("{c}") AS m{i}, stddev_pop("{c}") AS s{i}' for i, c in enumerate(_ALL46))
_SCALED = ", ".join(
    f"""{r(f'("{c}" - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END')} AS "{c}" """ for i, c in enumerate(_ALL46)
)
put(
    "standard_scale",
    f"SELECT customerID, {_SCALED} FROM coded, stats",
    CLEAN,
    FEATURES,
    f"coded AS (SELECT customerID, {_NAMED} FROM feat)",
    f"stats AS (SELECT {_STATS} FROM coded WHERE NOT substr({_HASH}, 1, 8) < '33333333')",
)
put(
    "default_total_charges",
    "SELECT customerID, coalesce(TRY_CAST(TotalCharges AS DOUBLE), MonthlyCharges * tenure) AS TotalCharges FROM sub",
)
put("score_linear", "SELECT customerID, p FROM sc", SCORED)
put("risk_level", f"SELECT customerID, p, {_LEVEL.format(p='p')} AS risk_level FROM sc", SCORED)

# --- sweeps: brute force over every threshold ----------------------------------------------
SWEEP = """
grid AS (SELECT CAST(i AS INT) AS position, CAST(0.1 AS DOUBLE) + i * CAST(0.008 AS DOUBLE) AS t FROM range(101) g(i)),
cut AS (
  SELECT position, t, count(*) FILTER (p >= t AND y = 1) AS tp, count(*) FILTER (p >= t AND y = 0) AS fp,
         count(*) FILTER (p < t AND y = 1) AS fn, count(*) FILTER (p < t AND y = 0) AS tn
  FROM sc, grid GROUP BY position, t),
sw AS (
  SELECT *, CASE WHEN 2*tp+fp+fn = 0 THEN 0 ELSE 2*tp / (2*tp+fp+fn) END AS f1,
    CASE WHEN tp+fp = 0 THEN 0 ELSE tp / (tp+fp) END AS prec, CASE WHEN tp+fn = 0 THEN 0 ELSE tp / (tp+fn) END AS rec,
    tp * CAST(1000 AS DOUBLE) - (tp + fp) * CAST(100 AS DOUBLE) AS net FROM cut)"""
put(
    "apply_threshold",
    """SELECT customerID, p, CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS INT) AS predicted_default,
    CAST(CASE WHEN p >= (SELECT t FROM sw ORDER BY f1 DESC, t LIMIT 1) THEN 1 ELSE 0 END AS INT) AS predicted_f1,
    CAST(CASE WHEN p >= (SELECT t FROM sw ORDER BY net DESC, t LIMIT 1) THEN 1 ELSE 0 END AS INT) AS predicted_business FROM sc""",
    SCORED,
    SWEEP,
)
put("threshold_sweep", f"SELECT position, {r('t')} AS threshold, {r('f1')} AS f1_score, {r('prec')} AS precision, {r('rec')} AS recall FROM sw", SCORED, SWEEP)
put("best_f1_threshold", f"SELECT {r('t')} AS threshold, {r('f1')} AS f1_score FROM sw ORDER BY f1 DESC, t LIMIT 1", SCORED, SWEEP)
put("argmax_threshold", f"SELECT {r('t')} AS threshold, {r('prec')} AS precision FROM sw ORDER BY prec DESC, t LIMIT 1", SCORED, SWEEP)
put("business_sweep", f"SELECT position, {r('t')} AS threshold, tp, fp, {r('net')} AS net_benefit FROM sw", SCORED, SWEEP)
put("best_business_threshold", f"SELECT {r('t')} AS threshold, {r('net')} AS net_benefit FROM sw ORDER BY net DESC, t LIMIT 1", SCORED, SWEEP)

_RULES = (
    ("Contract = 'Month-to-month'", "Month-to-month contract"),
    ("InternetService = 'Fiber optic'", "Fiber optic internet service"),
    ("PaymentMethod = 'Electronic check'", "Electronic check payment method"),
    ("tenure < 12", "Customer tenure less than 1 year"),
    ("OnlineSecurity = 'No' AND InternetService <> 'No'", "No online security service"),
    ("TechSupport = 'No' AND InternetService <> 'No'", "No technical support"),
)
_NONE = " AND ".join(f"NOT ({test})" for test, _ in _RULES)
put(
    "risk_factors",
    " UNION ALL ".join(f"SELECT customerID, '{text}' AS risk_factor FROM sub WHERE {test}" for test, text in _RULES)
    + f" UNION ALL SELECT customerID, NULL FROM sub WHERE {_NONE}",
)
put(
    "recommendations",
    """SELECT b.customerID, b.predicted_churn, a.position, a.action
    FROM (SELECT customerID, CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS INT) AS predicted_churn FROM sc) b JOIN (VALUES
      (1, 0, 'Offer a promotion for upgrading to a longer-term contract'),
      (1, 1, 'Provide discounted security and support services'),
      (1, 2, 'Consider a loyalty program or special pricing'),
      (0, 0, 'Regular check-ins to ensure continued satisfaction'),
      (0, 1, 'Cross-sell additional services'),
      (0, 2, 'Highlight long-term benefits of current subscription')) a(cls, position, action)
    ON a.cls = b.predicted_churn""",
    SCORED,
)
put("charge_scatter", "SELECT Churn, tenure, MonthlyCharges FROM sub WHERE Churn IN ('Yes', 'No')")
put(
    "charge_scatter_binned",
    """SELECT Churn, CAST(floor(tenure / 3) * 3 AS BIGINT) AS tenure, CAST(floor(MonthlyCharges / 5) * 5 AS BIGINT) AS MonthlyCharges,
    count(*) AS n FROM sub GROUP BY 1, 2, 3""",
)

# --- filters and validators ------------------------------------------------------------------
_IN = "Contract IN ('Month-to-month', 'Two year') AND InternetService IN ('DSL', 'Fiber optic')"
put("filter_customers", f"SELECT * FROM sub WHERE {_IN}")
put("filter_counts", f"SELECT count(*) FILTER ({_IN}) AS shown, count(*) AS total FROM sub")
put(
    "filter_options",
    """SELECT DISTINCT 'Contract' AS "column", Contract AS option FROM sub
    UNION ALL SELECT DISTINCT 'InternetService', InternetService FROM sub""",
)
put("first_year_monthly", "SELECT customerID, Contract, tenure, MonthlyCharges FROM sub WHERE Contract = 'Month-to-month' AND tenure < 12")
_T, _M = "TRY_CAST(tenure AS DOUBLE)", "TRY_CAST(MonthlyCharges AS DOUBLE)"
_STRICT = f"""CASE WHEN Contract IS NULL THEN 'Missing required fields: Contract'
  WHEN {_T} IS NULL OR {_T} < 0 THEN 'Tenure must be a non-negative number'
  WHEN {_M} IS NULL OR {_M} <= 0 THEN 'MonthlyCharges must be a positive number'
  WHEN Contract NOT IN ('Month-to-month', 'One year', 'Two year') THEN 'Contract must be ''Month-to-month'', ''One year'', or ''Two year'''
  WHEN InternetService NOT IN ('DSL', 'Fiber optic', 'No') THEN 'InternetService must be ''DSL'', ''Fiber optic'', or ''No''' END"""
_LENIENT = f"""CASE WHEN Contract IS NULL THEN 'Missing required fields: Contract'
  WHEN {_T} IS NULL THEN 'Tenure must be a number' WHEN {_M} IS NULL THEN 'MonthlyCharges must be a number' END"""
put("validate_strict", f"SELECT customerID, tenure, MonthlyCharges, InternetService, Contract, PaymentMethod, {_STRICT} AS error FROM req", REQUESTS)
put("validate_lenient", f"SELECT customerID, tenure, MonthlyCharges, Contract, {_LENIENT} AS error FROM req", REQUESTS)
put("split_valid", f"SELECT coalesce(customerID, 'Unknown') AS customer_id, tenure, MonthlyCharges, Contract, {_LENIENT} AS error FROM req", REQUESTS)


# Strict rules on bodies: an even tenure was sent as a number, any other as text.
_BODY = f"""CASE WHEN {_T} = 7 THEN 'Expected a list of customer data' WHEN Contract IS NULL THEN 'Missing required fields: Contract'
  WHEN {_T} IS NULL OR {_T} < 0 OR {_T} % 2 <> 0 THEN 'Tenure must be a non-negative number' ELSE {_STRICT} END"""
put(
    "validate_payloads",
    f"""SELECT if({_T} = 7, 'Unknown', coalesce(customerID, 'Unknown')) AS customer_id, {_BODY} AS error,
    if({_T} = 7, NULL, Contract) AS Contract FROM req""".replace(f"if({_T} = 7,", f"if(coalesce({_T} = 7, false),"),
    REQUESTS,
)


def _verdict(name: str, source: str, strict: bool) -> str:
    checks = (
        (f"{_T} >= 0", "Tenure must be a non-negative number"),
        (f"{_M} > 0", "MonthlyCharges must be a positive number"),
        ("Contract IN ('Month-to-month', 'One year', 'Two year')", "Contract must be ''Month-to-month'', ''One year'', or ''Two year''"),
        ("InternetService IN ('DSL', 'Fiber optic', 'No')", "InternetService must be ''DSL'', ''Fiber optic'', or ''No''"),
    )
    if not strict:
        checks = ((f"{_T} IS NOT NULL", "Tenure must be a number"), (f"{_M} IS NOT NULL", "MonthlyCharges must be a number"))
    arms = " ".join(f"WHEN NOT bool_and(coalesce({test}, false)) THEN '{text}'" for test, text in checks)
    return f"SELECT '{name}' AS input, {str(strict).lower()} AS strict, CASE {arms} ELSE 'Data is valid' END AS message FROM {source}"


put(
    "validate_frame",
    "SELECT input, strict, message = 'Data is valid' AS is_valid, message FROM ("
    + " UNION ALL ".join(_verdict(n, s, f) for n, s in (("sound", "sub"), ("requests", "req")) for f in (True, False))
    + ")",
    REQUESTS,
)
put("complete_numeric", "SELECT CAST(tenure AS DOUBLE) AS tenure, MonthlyCharges, TotalCharges FROM num WHERE TotalCharges IS NOT NULL", CLEAN)
put(
    "score_records",
    f"""SELECT customer_id, error, p AS churn_probability, p >= 0.5 AS will_churn,
    CASE WHEN p IS NOT NULL THEN {_LEVEL.format(p='p')} END AS risk_level
    FROM (SELECT *, CASE WHEN error IS NULL THEN {P_MAIN} END AS p FROM (
      SELECT * REPLACE ({_T} AS tenure, {_M} AS MonthlyCharges), coalesce(customerID, 'Unknown') AS customer_id, {_LENIENT} AS error FROM req))""",
    REQUESTS,
)
SQL["score_stream"] = SQL["score_records"]
SQL["score_payloads"] = SQL["score_records"].replace(
    "AS customer_id, " + _LENIENT,
    f"AS customer_id, CASE WHEN {_T} = 7 THEN 'Expected a list of customer data' ELSE {_LENIENT} END",
).replace("coalesce(customerID, 'Unknown')", f"CASE WHEN {_T} = 7 THEN 'Unknown' ELSE coalesce(customerID, 'Unknown') END")

# --- joins --------------------------------------------------------------------------------------
COHORT = """
coh AS (
  SELECT a.customerID, count(b.customerID) AS similar_customers,
    coalesce(count(*) FILTER (b.Churn = 'Yes') / nullif(count(b.Churn), 0), 0.0) AS rate
  FROM sub a LEFT JOIN sub b ON b.Contract = a.Contract AND b.InternetService = a.InternetService
    AND b.tenure >= greatest(0, a.tenure - 12) AND b.tenure <= a.tenure + 12
  GROUP BY a.customerID)"""
put(
    "similar_customers",
    f"SELECT s.customerID, Contract, InternetService, tenure, similar_customers, {r('rate')} AS cohort_churn_rate FROM sub s JOIN coh USING (customerID)",
    COHORT,
)
put(
    "cohort_risk_compare",
    f"SELECT sc.customerID, p, {r('rate')} AS cohort_churn_rate, CASE WHEN p > rate THEN 'higher than average' ELSE 'lower than average' END AS risk_vs_cohort FROM sc JOIN coh USING (customerID)",
    SCORED,
    COHORT,
)

# --- quality numbers ------------------------------------------------------------------------------
CONFUSION = """
cm AS (SELECT count(*) FILTER (p >= 0.5 AND y = 1) AS tp, count(*) FILTER (p >= 0.5 AND y = 0) AS fp,
              count(*) FILTER (p < 0.5 AND y = 1) AS fn, count(*) FILTER (p < 0.5 AND y = 0) AS tn FROM sc)"""


def _metrics(source: str, group: str = "") -> tuple[str, ...]:
    """Six metrics per group: AUC by ranks with half credit for ties, AP step by step."""
    by, on = (f"{group}, ", f"PARTITION BY {group} ") if group else ("", "")
    over = f"OVER ({on}ORDER BY p DESC)"
    grouped = f"GROUP BY {group}" if group else ""
    return (
        f"dist AS (SELECT {by}p, sum(y) AS pos, count(*) - sum(y) AS neg FROM {source} GROUP BY {by}p)",
        f"run AS (SELECT {by}p, pos, neg, sum(pos) {over} AS tp, sum(neg) {over} AS fp FROM dist)",
        f"""areas AS (SELECT {by}sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS roc_auc,
          sum(pos * (tp / (tp + fp))) / sum(pos) AS avg_precision,
          coalesce(sum(pos) FILTER (p >= 0.5), 0) AS tp, coalesce(sum(neg) FILTER (p >= 0.5), 0) AS fp,
          coalesce(sum(pos) FILTER (p < 0.5), 0) AS fn, coalesce(sum(neg) FILTER (p < 0.5), 0) AS tn FROM run {grouped})""",
        f"""met AS (SELECT {by}(tp+tn) / (tp+fp+fn+tn) AS accuracy, CASE WHEN tp+fp = 0 THEN 0 ELSE tp / (tp+fp) END AS precision,
          CASE WHEN tp+fn = 0 THEN 0 ELSE tp / (tp+fn) END AS recall,
          CASE WHEN 2*tp+fp+fn = 0 THEN 0 ELSE 2*tp / (2*tp+fp+fn) END AS f1_score, roc_auc, avg_precision FROM areas)""",
    )


_SIX = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "avg_precision")
_SIX_SQL = ", ".join(f"{r(c)} AS {c}" for c in _SIX)
put("evaluate_model", f"SELECT {_SIX_SQL} FROM met", SCORED, *_metrics("sc"))
put("write_metrics", f"SELECT {_SIX_SQL} FROM met", SCORED, *_metrics("sc"))
put(
    "read_artifacts",
    "SELECT "
    + ", ".join(f"{r(c)} AS {c}" for c in ("accuracy", "f1_score", "roc_auc", "avg_precision"))
    + ", CAST(0.57 AS DOUBLE) AS precision, CAST(0.50 AS DOUBLE) AS recall FROM met",
    SCORED,
    *_metrics("sc"),
)
put("roc_auc", f"SELECT {r('roc_auc')} AS roc_auc FROM met", SCORED, *_metrics("sc"))
put("average_precision", f"SELECT {r('avg_precision')} AS avg_precision FROM met", SCORED, *_metrics("sc"))
put(
    "baseline_compare",
    f"""SELECT metric, baseline, {r('cur')} AS "current", {r('(cur - baseline) * 100')} AS improvement FROM (
      SELECT 'accuracy' AS metric, CAST(0.735 AS DOUBLE) AS baseline, accuracy AS cur FROM met
      UNION ALL SELECT 'roc_auc', 0.65, roc_auc FROM met UNION ALL SELECT 'f1_score', 0.41, f1_score FROM met)""",
    SCORED,
    *_metrics("sc"),
)
_EACH = " UNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS model, {p} AS p, CASE Churn WHEN 'Yes' THEN 1 ELSE 0 END AS y FROM sub"
    for i, (n, p) in enumerate(_MODELS)
)
put(
    "select_best_model",
    f"SELECT position, model, {_SIX_SQL} FROM met ORDER BY f1_score DESC, position LIMIT 1",
    f"long AS ({_EACH})",
    *_metrics("long", "position, model"),
)
put(
    "soft_vote",
    "SELECT customerID, " + ", ".join(f"{p} AS p_{n}" for n, p in _MODELS)
    + f", {r('(' + ' + '.join(p for _, p in _MODELS) + ') / 4', 8)} AS p FROM sub",
)
put(
    "confusion_matrix",
    "SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cm UNION ALL SELECT 0, 1, fp FROM cm UNION ALL SELECT 1, 0, fn FROM cm UNION ALL SELECT 1, 1, tp FROM cm",
    SCORED,
    CONFUSION,
)
put(
    "classification_report",
    f"""SELECT label, {r('pr')} AS precision, {r('re')} AS recall, {r('f')} AS f1_score, support FROM (
      SELECT '0' AS label, p0 AS pr, r0 AS re, f0 AS f, n0 AS support FROM rep
      UNION ALL SELECT '1', p1, r1, f1, n1 FROM rep
      UNION ALL SELECT 'accuracy', NULL, NULL, acc, n0+n1 FROM rep
      UNION ALL SELECT 'macro avg', (p0+p1)/2, (r0+r1)/2, (f0+f1)/2, n0+n1 FROM rep
      UNION ALL SELECT 'weighted avg', (p0*n0+p1*n1)/(n0+n1), (r0*n0+r1*n1)/(n0+n1), (f0*n0+f1*n1)/(n0+n1), n0+n1 FROM rep)""",
    SCORED,
    CONFUSION,
    """rep AS (SELECT tn/(tn+fn) AS p0, tn/(tn+fp) AS r0, 2*tn/(2*tn+fn+fp) AS f0, tn+fp AS n0,
      tp/(tp+fp) AS p1, tp/(tp+fn) AS r1, 2*tp/(2*tp+fn+fp) AS f1, tp+fn AS n1, (tp+tn)/(tp+fp+fn+tn) AS acc FROM cm)""",
)
ROC = """
tot AS (SELECT sum(pos) AS np, sum(neg) AS nn FROM dist),
step AS (SELECT *, row_number() OVER (ORDER BY p DESC) AS rn, lead(pos) OVER (ORDER BY p DESC) AS npos,
                lead(neg) OVER (ORDER BY p DESC) AS nneg FROM run),
roc AS (SELECT p, tp / np AS tpr, fp / nn AS fpr FROM step, tot WHERE rn = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg),
prc AS (SELECT p, tp / (tp + fp) AS prec, tp / np AS rec FROM run, tot)"""
_DIST = _metrics("sc")[:2]
_START = "SELECT CAST('Infinity' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr UNION ALL "
put("roc_curve", f"{_START}SELECT p, {r('fpr')}, {r('tpr')} FROM roc", SCORED, *_DIST, ROC)
put("roc_curve_full", f"{_START}SELECT p, {r('fp / nn')}, {r('tp / np')} FROM run, tot", SCORED, *_DIST, ROC)
put(
    "pr_curve",
    f"SELECT p AS threshold, {r('prec')} AS precision, {r('rec')} AS recall FROM prc UNION ALL SELECT NULL, 1.0, 0.0",
    SCORED,
    *_DIST,
    ROC,
)
put(
    "write_curves",
    f"""SELECT 'roc' AS curve, {r('fpr')} AS x, {r('tpr')} AS y FROM roc UNION ALL SELECT 'roc', 0.0, 0.0
    UNION ALL SELECT 'pr', {r('rec')}, {r('prec')} FROM prc UNION ALL SELECT 'pr', 0.0, 1.0""",
    SCORED,
    *_DIST,
    ROC,
)

# --- money ------------------------------------------------------------------------------------------
put(
    "campaign_roi",
    f"""SELECT t AS threshold, targeted, {r('cost')} AS cost, {r('saved')} AS saved, {r('saved*1000')} AS revenue, {r('saved*1000 - cost')} AS net_benefit,
    {r('CASE WHEN cost = 0 THEN 0 ELSE (saved*1000 - cost) / cost END')} AS roi FROM (
      SELECT t, count(*) FILTER (p >= t) AS targeted, count(*) FILTER (p >= t) * CAST(100 AS DOUBLE) AS cost,
             count(*) FILTER (p >= t) * CAST(0.3 AS DOUBLE) AS saved
      FROM sc, (SELECT CAST(unnest([0.3, 0.4, 0.5, 0.6, 0.7, 0.8]) AS DOUBLE) AS t) GROUP BY t)""",
    SCORED,
)
put(
    "threshold_impact",
    f"""SELECT CAST(0.5 AS DOUBLE) AS threshold, {r('tp/(tp+fp)')} AS precision, {r('tp/(tp+fn)')} AS recall, {r('2*tp/(2*tp+fp+fn)')} AS f1_score,
    {r('(tp+tn)/(tp+fp+fn+tn)')} AS accuracy, tp+fp AS flagged, tp AS saved, CAST((tp+fp)*100 AS DOUBLE) AS cost, CAST(tp*1000 AS DOUBLE) AS benefit,
    CAST(tp*1000 - (tp+fp)*100 AS DOUBLE) AS net_benefit, {r('(tp*1000 - (tp+fp)*100) / ((tp+fp)*100)')} AS roi FROM cm""",
    SCORED,
    CONFUSION,
)
put(
    "annual_value",
    f"""SELECT tp+fn AS churners, {r('tp/(tp+fn)')} AS identified_share, {r('(tp+fn) * (tp/(tp+fn)) * CAST(0.3 AS DOUBLE)')} AS customers_saved,
    {r('(tp+fn) * (tp/(tp+fn)) * CAST(0.3 AS DOUBLE) * 1000')} AS annual_value FROM cm""",
    SCORED,
    CONFUSION,
)
put("at_risk_total", "SELECT count(*) FILTER (p >= 0.5) AS at_risk, count(*) AS customers FROM sc", SCORED)
put(
    "predicted_vs_actual",
    """SELECT period, predicted, actual, predicted - actual AS difference, abs(predicted - actual) AS absolute_error FROM (
      SELECT CAST(year(last_order)*100 + month(last_order) AS INT) AS period, count(*) FILTER (p >= 0.5) AS predicted,
             CAST(sum(y) AS BIGINT) AS actual
      FROM sc JOIN subk USING (customerID) WHERE last_order IS NOT NULL GROUP BY 1)""",
    SCORED,
)

# --- reports -------------------------------------------------------------------------------------------
_FY = "Contract = 'Month-to-month' AND tenure < 12"
put(
    "churn_kpis",
    f"""SELECT count(*) AS customers, count(*) FILTER (Churn = 'Yes') AS churned, {r('sum(MonthlyCharges)')} AS monthly_revenue,
    {r("sum(MonthlyCharges) FILTER (Churn = 'Yes')")} AS at_risk_revenue, count(*) FILTER ({_FY}) AS first_year_monthly,
    {r('avg(tenure)')} AS avg_tenure, {r('avg(MonthlyCharges)')} AS avg_monthly,
    {r("count(*) FILTER (Churn = 'Yes') / count(*) * 100")} AS churn_rate,
    {r("sum(MonthlyCharges) FILTER (Churn = 'Yes') / sum(MonthlyCharges) * 100")} AS at_risk_share FROM sub""",
)
put("churn_distribution", f"SELECT Churn, count(*) AS customers, {r('count(*) / (SELECT count(*) FROM sub) * 100')} AS percent FROM sub GROUP BY Churn")
_RATE = r("count(*) FILTER (Churn = 'Yes') / count(*) * 100")
for _name, _column in (("churn_by_contract", "Contract"), ("churn_by_internet", "InternetService"), ("churn_by_payment", "PaymentMethod")):
    put(_name, f"SELECT {_column}, {_RATE} AS churn_rate FROM sub GROUP BY {_column}")
put(
    "churn_by_tenure_group",
    f"SELECT tenure_group, {_RATE} AS churn_rate, position FROM (SELECT *, {_GROUP} AS tenure_group, {_GROUP_RANK} AS position FROM sub) WHERE tenure_group IS NOT NULL GROUP BY tenure_group, position",
)
_RATE_NO = r("count(*) FILTER (Churn = 'No') / count(*) * 100")
put("crosstab_rate", f'SELECT MultipleLines, count(*) AS customers, {_RATE_NO} AS "No", {_RATE} AS "Yes" FROM sub GROUP BY MultipleLines')
put(
    "lifetime_value",
    f"""SELECT Contract, {r('m')} AS avg_monthly, {r('c')} AS churn_rate, {r('t')} AS avg_tenure,
    {r('CASE WHEN c > 0 THEN 1/c ELSE 60 END')} AS lifetime_months, {r('m * CASE WHEN c > 0 THEN 1/c ELSE 60 END')} AS lifetime_value FROM (
      SELECT Contract, avg(MonthlyCharges) AS m, avg(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) AS c, avg(tenure) AS t FROM sub GROUP BY Contract)""",
)
put(
    "correlation_matrix",
    f"""SELECT 'tenure' AS feature, 1.0::DOUBLE AS tenure, {r('a')} AS MonthlyCharges, {r('b')} AS TotalCharges FROM cc
    UNION ALL SELECT 'MonthlyCharges', {r('a')}, 1.0, {r('c')} FROM cc UNION ALL SELECT 'TotalCharges', {r('b')}, {r('c')}, 1.0 FROM cc""",
    CLEAN,
    "cc AS (SELECT corr(tenure, MonthlyCharges) AS a, corr(tenure, TotalCharges) AS b, corr(MonthlyCharges, TotalCharges) AS c FROM num WHERE TotalCharges IS NOT NULL)",
)
put("class_counts", "SELECT Churn, count(*) AS n FROM cl GROUP BY Churn", CLEAN)
put(
    "class_weights",
    f"""SELECT scheme, {r('a')} AS weight_0, {r('b')} AS weight_1 FROM (
      SELECT 'scale_pos' AS scheme, 1.0::DOUBLE AS a, neg / greatest(1, pos) AS b FROM n2
      UNION ALL SELECT 'total_pos', 1.0, (neg + pos) / greatest(1, pos) FROM n2
      UNION ALL SELECT 'balanced', (neg + pos) / (2 * neg), (neg + pos) / (2 * pos) FROM n2)""",
    CLEAN,
    "n2 AS (SELECT count(*) FILTER (Churn = 1) AS pos, count(*) FILTER (Churn = 0) AS neg FROM cl)",
)
put(
    "observed_dependence",
    "SELECT feature, value, count(*) AS customers, "
    + r("avg(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END)")
    + """ AS churn_rate FROM (
      SELECT 'tenure' AS feature, CAST(tenure AS VARCHAR) AS value, Churn FROM sub
      UNION ALL SELECT 'MonthlyCharges', CAST(CAST(floor(MonthlyCharges / 10) * 10 AS BIGINT) AS VARCHAR), Churn FROM sub
      UNION ALL SELECT 'Contract', Contract, Churn FROM sub UNION ALL SELECT 'InternetService', InternetService, Churn FROM sub
      UNION ALL SELECT 'PaymentMethod', PaymentMethod, Churn FROM sub) GROUP BY feature, value""",
)

# --- samples and balancing --------------------------------------------------------------------------------
put("preview", _BATCH + f" ORDER BY {_HASH}, customerID LIMIT 5", SCORED)
put("explain_sample", f"SELECT customerID, tenure, MonthlyCharges, Contract FROM sub ORDER BY {_HASH}, customerID LIMIT 50")
put("stratified_split", f"SELECT customerID, Churn, substr({_HASH}, 1, 8) < '33333333' AS is_test FROM sub")
put(
    "stratified_split_exact",
    f"""SELECT customerID, Churn FROM (SELECT customerID, Churn, row_number() OVER (PARTITION BY Churn ORDER BY {_HASH}) AS rn,
    count(*) OVER (PARTITION BY Churn) AS n FROM sub) WHERE rn <= floor(n * CAST(0.2 AS DOUBLE) + 0.5)""",
)
put(
    "undersample",
    f"""SELECT customerID, Churn FROM (SELECT customerID, Churn, row_number() OVER (PARTITION BY Churn ORDER BY {_HASH}) AS rn FROM cl)
    WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM cl GROUP BY Churn))""",
    CLEAN,
)
put(
    "class_weighting",
    f"""SELECT customerID, Churn, {r('(SELECT count(*) FROM cl) / (2 * count(*) OVER (PARTITION BY Churn))')} AS weight FROM cl""",
    CLEAN,
)

# --- segments ---------------------------------------------------------------------------------------------
SEGMENTS = """
cen(c, a, b, d) AS (VALUES (0, 12.0::DOUBLE, 60.0::DOUBLE, 700.0::DOUBLE), (1, 36.0, 65.0, 2400.0), (2, 58.0, 95.0, 5500.0)),
seg AS (
  SELECT customerID, tenure, MonthlyCharges, TotalCharges, Churn, arg_min(c, (tenure-a)*(tenure-a) + (MonthlyCharges-b)*(MonthlyCharges-b) + (TotalCharges-d)*(TotalCharges-d)) AS Cluster
  FROM cl, cen GROUP BY ALL),
prof AS (
  SELECT Cluster, round_even(avg(Churn), 3) AS ChurnRate, count(*) AS "Count", round_even(count(*) / (SELECT count(*) FROM seg) * 100, 1) AS Percentage,
    round_even(avg(tenure), 1) AS tenure, round_even(avg(MonthlyCharges), 1) AS MonthlyCharges, round_even(avg(TotalCharges), 1) AS TotalCharges
  FROM seg GROUP BY Cluster)"""
put("assign_segments", "SELECT customerID, tenure, MonthlyCharges, TotalCharges, Cluster FROM seg", CLEAN, SEGMENTS)
put("segment_profile", "SELECT * FROM prof", CLEAN, SEGMENTS)
put("write_segments", "SELECT * FROM prof", CLEAN, SEGMENTS)
put("segment_risk", f'SELECT Cluster, ChurnRate, "Count", {r(chr(34) + "Count" + chr(34) + " / (SELECT count(*) FROM seg) * 1000")} AS weight FROM prof', CLEAN, SEGMENTS)

# --- explanation --------------------------------------------------------------------------------------------
_MEANS = ", ".join(f"avg({sql}) AS m{i}" for i, (sql, _) in enumerate(_TERMS.values()))
_PHI = {f: f"(({sql}) - m{i}) * CAST({w} AS DOUBLE)" for i, (f, (sql, w)) in enumerate(_TERMS.items())}
EXPLAIN = (
    f"mean AS (SELECT {_MEANS} FROM sub)",
    "imp AS (" + " UNION ALL ".join(f"SELECT '{f}' AS Feature, avg(abs({phi})) AS Importance FROM sub, mean" for f, phi in _PHI.items()) + ")",
)
put("shap_linear_rows", "SELECT customerID, " + ", ".join(f'{r(phi)} AS "{f}"' for f, phi in _PHI.items()) + " FROM sub, mean", EXPLAIN[0])
for _name in ("shap_linear", "importance_table", "write_importance"):
    put(_name, f"SELECT Feature, {r('Importance', 9)} AS Importance FROM imp", *EXPLAIN)
put("top_features", f"SELECT Feature, {r('Importance', 9)} AS Importance FROM imp ORDER BY imp.Importance DESC, Feature LIMIT 10", *EXPLAIN)


def _dependence(feature: str, grid: str, numeric: bool) -> str:
    shown = ("CAST(NULL AS VARCHAR)", "g") if numeric else ("g", "CAST(NULL AS DOUBLE)")
    return (
        f"SELECT '{feature}' AS feature, {shown[0]} AS category, {r(shown[1]) if numeric else shown[1]} AS value, {r(f'avg({P_MAIN})')} AS probability "
        f"FROM (SELECT s.* REPLACE (g AS {feature}), g FROM sub s, ({grid})) GROUP BY g"
    )


_NUM_GRID = "SELECT CAST({lo} AS DOUBLE) + i * CAST({step!r} AS DOUBLE) AS g FROM range(100) t(i)"
put(
    "partial_dependence",
    " UNION ALL ".join(
        [
            _dependence("tenure", _NUM_GRID.format(lo=0, step=72 / 99), True),
            _dependence("MonthlyCharges", _NUM_GRID.format(lo=20, step=100 / 99), True),
            *[
                _dependence(c, "SELECT unnest([" + ", ".join(f"'{v}'" for v in _LEVELS[c]) + "]) AS g", False)
                for c in ("Contract", "InternetService", "PaymentMethod")
            ],
        ]
    ),
)

TRAIN = f"""
tr AS (SELECT CAST(Churn AS DOUBLE) AS label, count(*) AS n FROM cl WHERE NOT substr({_HASH}, 1, 8) < '33333333' GROUP BY 1)"""
TEST = f"""
te AS (SELECT count(*) AS n FROM cl WHERE Churn IS NOT NULL AND substr({_HASH}, 1, 8) < '33333333')"""
put(
    "tree_contributions",
    "SELECT model, n AS n_rows, 46 AS n_features, n AS adding_up FROM te, (VALUES ('gbt_leafwise'), ('random_forest')) AS v(model)",
    CLEAN,
    TEST,
)
put("tree_dependence", "SELECT member, 46 AS n_features, 0 AS broken, 46 AS last_steps FROM (VALUES (0), (1)) AS v(member)")
put(
    "out_of_fold_selection",
    """SELECT model, CAST(n AS BIGINT) AS n_rows, CAST(n AS BIGINT) AS customers, 0 AS test_rows, true AS first_best
    FROM (SELECT sum(n) AS n FROM tr), (VALUES ('logistic'), ('random_forest')) AS v(model)""",
    CLEAN,
    TRAIN,
)
put(
    "score_records_gaps",
    f"""SELECT gap, count(*) AS records, count(*) FILTER (WHERE {_LENIENT} IS NULL AND {_T} <> -1) AS valid, count(*) FILTER (WHERE {_LENIENT} IS NULL AND {_T} <> -1) AS scored,
    count(*) FILTER (WHERE {_LENIENT} IS NULL AND {_T} <> -1) AS as_missing
    FROM req, (VALUES ('NaN'), ('1.0d'), ('abc')) AS v(gap) WHERE customerID IS NOT NULL GROUP BY gap""",
    REQUESTS,
)
put("median_sketch", "SELECT count(MonthlyCharges) AS n, true AS within, count(MonthlyCharges) AS sketched FROM sub")
put("oversample_smote", "SELECT label, n AS before, (SELECT max(n) FROM tr) AS after FROM tr", CLEAN, TRAIN)
put(
    "booster_properties",
    """SELECT model, 20 AS trees, 0 AS too_large, 0 AS wrong_leaves, 0 AS rounds_without_gain, 0 AS mixed_levels
    FROM (VALUES ('gbt_weighted'), ('gbt_leafwise'), ('gbt_symmetric')) AS v(model)""",
)
_MISSING = "(SELECT max(n) - min(n) FROM tr)"
put(
    "smote_segments",
    f"SELECT label, {_MISSING} AS synthetic, {_MISSING} AS on_segment, {_MISSING} AS between_minority_rows FROM tr ORDER BY n, label DESC LIMIT 1",
    CLEAN,
    TRAIN,
)
put(
    "balance",
    """SELECT 'smote' AS method, label, (SELECT max(n) FROM tr) AS n FROM tr UNION ALL SELECT 'undersampling', label, (SELECT min(n) FROM tr) FROM tr
    UNION ALL SELECT 'class_weight', label, n FROM tr UNION ALL SELECT 'other', label, n FROM tr""",
    CLEAN,
    TRAIN,
)
