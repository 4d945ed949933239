"""The data chain in the shape of the schema contract: ids as text, every column, every type.

Each table follows ``schemas.SCHEMAS``. Small ones are stored beside the tables they come from, bucketed by
the same keys. The large ones (account months, payments, scores, bureau rows) are made row by row from
stored tables when they are read; of them only the numbers of their ids are stored, in the same buckets.
Ids are numbers of the natural order, or the padded form of the table's own number.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import padded_id
from ..operators import drift, quality
from ..sources import schemas, tables
from ..sources.portfolio import ROW_KEY
from ..sources.store import Layout, StoredPortfolio
from .registry import query

# Prefixes and widths of the contract's ids.
CUSTOMER_ID = ("CUST", 7)
ACCOUNT_ID = ("ACCT", 8)
MACRO_ID = ("MACRO", 8)
SCENARIO_MONTH_ID = ("SCENARIO", 8)
BUREAU_ID = ("BUREAU", 10)
PAYMENT_ID = ("PAY", 10)
SCORE_ID = ("SCORE", 10)


def _id(kind: tuple[str, int], number: str) -> Column:
    return padded_id(kind[0], number, kind[1])


def _texts(df: DataFrame, *names: str) -> DataFrame:
    """Customer and account numbers as ids; a row's own id is rewritten with them."""
    kinds = {"customer_id": CUSTOMER_ID, "account_id": ACCOUNT_ID}
    return df.withColumns({n: _id(kinds[n], n) for n in names})


def _numbered_rows(p: StoredPortfolio, df: DataFrame, table: str, column: str, kind: tuple[str, int], order: list[str]) -> DataFrame:
    """The rows with their id; only (key, number) is stored, in the buckets of the rows."""
    numbers = p.store.table(f"numbers_{table}", lambda: tables.number_rows_by(df, order, "_row_no"), Layout(order[0], tuple(order)))
    return df.join(numbers, order).withColumn(column, _id(kind, "_row_no")).drop("_row_no")


def _customers(p: StoredPortfolio) -> DataFrame:
    return _texts(p.customers, "customer_id")


def _accounts(p: StoredPortfolio) -> DataFrame:
    return _texts(p.accounts, "account_id", "customer_id")


def _macro(p: StoredPortfolio) -> DataFrame:
    return tables.with_surrogate_key(p.macro_monthly, "macro_id", *MACRO_ID, ["month", "state", "zip3"])


def _scenarios(p: StoredPortfolio) -> DataFrame:
    return tables.with_surrogate_key(p.policy_scenarios, "scenario_month_id", *SCENARIO_MONTH_ID, ["scenario_id", "month"])


def _bureau(p: StoredPortfolio) -> DataFrame:
    keyed = _numbered_rows(p, p.bureau_monthly, "bureau_monthly", "bureau_snapshot_id", BUREAU_ID, ["customer_id", "month"])
    return _texts(keyed, "customer_id")


def _snapshots(p: StoredPortfolio) -> DataFrame:
    return _texts(p.account_monthly_snapshots, "account_id", "customer_id")


def _payments(p: StoredPortfolio) -> DataFrame:
    keyed = _numbered_rows(p, p.payment_events, "payment_events", "payment_id", PAYMENT_ID, ["account_id", "month", "scenario_id"])
    return _texts(keyed, "account_id", "customer_id")


def _audit(p: StoredPortfolio) -> DataFrame:
    """Scores, calibration, drivers and the governance columns, of the baseline's account months."""
    keyed = _numbered_rows(p, p.audit, "model_scoring_audit", "score_id", SCORE_ID, ROW_KEY)
    flags = {c: F.lit(False) for c in ("drift_alert_flag", "fairness_alert_flag", "override_flag")}
    named = keyed.withColumn("account_month_id", F.concat_ws("|", F.col("account_id").cast("string"), F.col("month").cast("string"), F.lit("baseline")))
    return _texts(named.withColumns({"psi_score": F.lit(0.0), **flags}), "account_id", "customer_id")


def _drift(p: StoredPortfolio) -> DataFrame:
    rows = p.modeling_dataset.select("month", *drift.DRIFT_FEATURES)
    return drift.drift_table(drift.psi(drift.with_period(rows), drift.DRIFT_FEATURES))


_READ = Layout(projected=True)
_BY_CUSTOMER, _BY_ACCOUNT = Layout("customer_id", ("customer_id",)), Layout("account_id", ("account_id",))
CONTRACT: dict[str, tuple[Callable[[StoredPortfolio], DataFrame], Layout]] = {
    "customers": (_customers, _BY_CUSTOMER),
    "accounts": (_accounts, _BY_ACCOUNT),
    "macro_monthly": (_macro, Layout()),
    "policy_scenarios": (_scenarios, Layout()),
    "bureau_monthly": (_bureau, _READ),
    "account_monthly_snapshots": (_snapshots, _READ),
    "payment_events": (_payments, _READ),
    "model_scoring_audit": (_audit, _READ),
    "model_feature_psi": (_drift, Layout()),
}


def contract_table(p: StoredPortfolio, name: str) -> DataFrame:
    """One table of the contract; what is stored of it is built when it is first asked for."""
    make, layout = CONTRACT[name]
    if layout.projected:  # its load time is that of the first call
        loaded = p.store.asked.setdefault(name, datetime.now())
        return schemas.conform(make(p).withColumn(schemas.LOAD_TIME, F.lit(loaded)), name, missing="error")
    return p.store.table(f"contract_{name}", lambda: schemas.conform(make(p), name, missing="error"), layout)


# --- checks -----------------------------------------------------------------


def _padded(kind: tuple[str, int], number: str) -> str:
    return f"'{kind[0]}_' || lpad(cast({number} as varchar), {kind[1]}, '0')"


_CUSTOMER, _ACCOUNT = _padded(CUSTOMER_ID, "customer_id"), _padded(ACCOUNT_ID, "account_id")


def _numbered(kind: tuple[str, int], order: str) -> str:
    return _padded(kind, f"row_number() over (order by {order})")


_SOURCE = {  # table: the view it comes from, and the ids' text
    "customers": ("customers", {"customer_id": _CUSTOMER}),
    "accounts": ("accounts", {"account_id": _ACCOUNT, "customer_id": _CUSTOMER}),
    "macro_monthly": (
        """(select *, unemployment_rate > 0.058e0 or inflation_rate > 0.042e0 or consumer_sentiment_index < 88e0 as recession_flag
          from macro_monthly)""",
        {"macro_id": _numbered(MACRO_ID, "month, state, zip3")},
    ),
    "policy_scenarios": ("policy_scenarios", {"scenario_month_id": _numbered(SCENARIO_MONTH_ID, "scenario_id, month")}),
    "bureau_monthly": ("bureau_monthly", {"bureau_snapshot_id": _numbered(BUREAU_ID, "customer_id, month"), "customer_id": _CUSTOMER}),
    "account_monthly_snapshots": ("account_monthly_snapshots", {"account_id": _ACCOUNT, "customer_id": _CUSTOMER}),
    "payment_events": (
        "payment_events",
        {"payment_id": _numbered(PAYMENT_ID, "account_id, month, scenario_id"), "account_id": _ACCOUNT, "customer_id": _CUSTOMER},
    ),
    "model_scoring_audit": (
        """(select *, concat_ws('|', cast(account_id as varchar), cast(month as varchar), 'baseline') as account_month_id,
            0e0 as psi_score, false as drift_alert_flag, false as fairness_alert_flag, false as override_flag from audit)""",
        {"score_id": _numbered(SCORE_ID, "account_id, month"), "account_id": _ACCOUNT, "customer_id": _CUSTOMER},
    ),
}
_SQL_TYPES = {"string": "varchar", "int": "int", "double": "double", "boolean": "boolean", "date": "date"}


def _contract_sql(table: str) -> str:
    source, ids = _SOURCE[table]
    columns = [
        f"cast({ids.get(f.name, f.name)} as {_SQL_TYPES[f.dataType.simpleString()]}) as {f.name}"
        for f in schemas.SCHEMAS[table]
        if f.name != schemas.LOAD_TIME
    ]
    return f"select {', '.join(columns)} from {source}"


def _register(table: str) -> None:
    @query(f"c_{table}", _contract_sql(table))
    def run(p: StoredPortfolio, table: str = table) -> DataFrame:
        return contract_table(p, table).drop(schemas.LOAD_TIME)


for _table in _SOURCE:
    _register(_table)

_KEYED = [t for t in schemas.PRIMARY_KEYS if t in CONTRACT]
_FOREIGN = [(c, q, k) for c, q, k in schemas.FOREIGN_KEYS if c in CONTRACT and q in CONTRACT]


def _keys_sql() -> str:
    named = ",\n".join(f"x_{t} as materialized ({_contract_sql(t)})" for t in _KEYED)
    parts = [
        f"""select '{t} key {schemas.PRIMARY_KEYS[t]}' as "check", count(*) as keys, cast(coalesce(sum(n), 0) as bigint) as rows from
        (select {schemas.PRIMARY_KEYS[t]}, count(*) as n from x_{t} group by 1 having count(*) > 1 or {schemas.PRIMARY_KEYS[t]} is null)"""
        for t in _KEYED
    ] + [
        f"""select '{c} to {q} by {k}', count(*), cast(coalesce(sum(n), 0) as bigint) from
        (select {k}, count(*) as n from x_{c} c where {k} is not null and not exists (select 1 from x_{q} q where q.{k} = c.{k}) group by 1)"""
        for c, q, k in _FOREIGN
    ]
    return f"with {named}\n{' union all '.join(parts)}"


@query("c_all_keys", _keys_sql())
def all_keys(p: StoredPortfolio) -> DataFrame:
    """Every primary and foreign key of the stored contract, in one pass over the keys of each table."""
    stored = {t: contract_table(p, t) for t in _KEYED}
    return quality.audit_keys(stored, {t: schemas.PRIMARY_KEYS[t] for t in _KEYED}, _FOREIGN)


