"""Places of the test tables, and hand-built contract rows for boundary cases."""
from __future__ import annotations

import datetime as dt

from bankroll.model import SCHEMAS

UTC = dt.timezone.utc
SF_SMALL = "/root/testdata/sf0.001"
VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()


def ts(s: str) -> dt.datetime:
    """ISO text (UTC) -> aware datetime."""
    return dt.datetime.fromisoformat(s.replace("Z", "+00:00")).astimezone(UTC)


def frame(spark, table, rows):
    names = [f.name for f in SCHEMAS[table].fields]
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, SCHEMAS[table])


def txn(txn_id, account_id="a1", amount=100.0, when="2025-01-15T10:00:00Z", txn_type="Deposit",
        status="approved", approver="e1", currency="INR", channel="Digital", product="p1"):
    return {"txn_id": txn_id, "account_id": account_id, "txn_type": txn_type, "amount": float(amount),
            "currency": currency, "txn_time": ts(when), "channel": channel, "status": status,
            "product_id": product, "approved_by_emp_id": approver}


def account(account_id, customer_id="c1", branch_id="b1", status="Active", closed=None):
    return {"account_id": account_id, "customer_id": customer_id, "account_type": "Savings",
            "status": status, "branch_id": branch_id, "opened_at": ts("2020-01-01T00:00:00Z"),
            "closed_at": closed}


def branch(branch_id, city, name=None):
    return {"branch_id": branch_id, "branch_name": name or f"{city} Branch", "city": city,
            "region": "West"}


def employee(emp_id, branch_id="b1", manager_id=None, role="Teller"):
    return {"emp_id": emp_id, "name": "N", "role": role, "branch_id": branch_id,
            "manager_id": manager_id, "hire_date": dt.date(2015, 1, 1)}


def tables(spark, txns=(), accounts=(), branches=(), employees=()):
    return {
        "transaction": frame(spark, "transaction", list(txns)),
        "account": frame(spark, "account", list(accounts) or [account("a1")]),
        "branch": frame(spark, "branch", list(branches) or [branch("b1", "Pune")]),
        "employee": frame(spark, "employee", list(employees) or [employee("e1")]),
    }
