"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs in DuckDB over the pre-registered TESTDATA views. The common table
expressions repeat the banking mapping of ``bankroll.sources.testdata`` in SQL; the
final SELECT is the rollup / read / check written the straightforward way (joins, then
one GROUP BY), independent of the Spark plan.
"""

from __future__ import annotations

_K = "((l_orderkey*7919 + l_partkey*104729 + l_linenumber*1299709) % 86400000)"
_N = "(select max(s_suppkey)+1 from supplier)"

MAPPING = {
    "bk_branch": """
select n_nationkey as branch_id, n_name as branch_name, r_name as city, r_name as region
from nation join region on n_regionkey = r_regionkey""",
    "bk_customer": """
select c_custkey as customer_id, c_name as name, cast(null as date) as dob,
       c_mktsegment as customer_segment, cast(null as varchar) as pan_hash, n_name as city,
       cast(null as timestamp) as created_at
from customer join nation on c_nationkey = n_nationkey""",
    "bk_employee": f"""
select s_suppkey as emp_id, s_name as name,
       case when s_suppkey*10 < {_N} then 'Manager' else 'Teller' end as role,
       s_nationkey as branch_id,
       case when s_suppkey = 0 then null
            when s_suppkey*10 < {_N} then 0
            else s_suppkey % cast(ceil({_N}*0.1) as bigint) end as manager_id,
       cast(null as date) as hire_date
from supplier""",
    "bk_product": """
select p_partkey as product_id, p_name as product_name, p_type as product_category from part""",
    "bk_account": """
select o_orderkey as account_id, o_custkey as customer_id, cast(null as varchar) as account_type,
       case o_orderstatus when 'F' then 'Active' when 'O' then 'Inactive' else 'Frozen' end as status,
       c_nationkey as branch_id, o_orderdate as opened_at,
       case when o_orderstatus = 'O' then o_orderdate + interval 30 day end as closed_at
from orders join customer on o_custkey = c_custkey""",
    "bk_txn": f"""
select md5(concat_ws('-', cast(l_orderkey as varchar), cast(l_partkey as varchar),
                     cast(l_suppkey as varchar), cast(l_linenumber as varchar),
                     cast(cast(l_quantity as int) as varchar))) as txn_id,
       l_orderkey as account_id,
       case l_linenumber % 6 when 0 then 'Deposit' when 1 then 'Withdrawal' when 2 then 'Transfer'
            when 3 then 'POS' when 4 then 'Fee' else 'EMI' end as txn_type,
       l_extendedprice as amount,
       case l_suppkey % 5 when 0 then 'USD' when 1 then 'EUR' when 2 then 'GBP'
            when 3 then 'INR' else 'AUD' end as currency,
       l_shipdate + to_milliseconds({_K}) as txn_time,
       case when cast(l_quantity as int) % 10 < 6 then 'Digital'
            when cast(l_quantity as int) % 10 < 9 then 'Branch' else 'POS' end as channel,
       case l_returnflag when 'A' then 'approved' when 'N' then 'pending' else 'declined' end as status,
       l_partkey as product_id,
       case when l_discount = 0 then null else l_suppkey end as approved_by_emp_id
from lineitem""",
}

_QUARTER = "cast(year({t}) as varchar) || 'Q' || cast(quarter({t}) as varchar)"

# The rollups as plain SQL over the mapped tables.
ROLLUP_SQL = {
    "q1": """
select account_id, strftime(txn_time, '%Y%m%d') as txn_day,
       strftime(txn_time, '%Y-%m-%dT%H:%M:%S.%f') as txn_timestamp, txn_id, currency, txn_type,
       channel, status, product_id, approved_by_emp_id, amount
from bk_txn""",
    "q2": """
select strftime(txn_time, '%Y%m%d%H%M') as txn_minute, txn_time, txn_id, account_id, currency,
       amount, channel, status
from bk_txn where amount > 10000 and not isnan(amount)""",
    "q3": """
select time_bucket(interval 1 hour, t.txn_time) as window_start,
       time_bucket(interval 1 hour, t.txn_time) + interval 1 hour as window_end,
       b.city, count(t.txn_id) as txn_count
from bk_txn t join bk_account a on t.account_id = a.account_id
     join bk_branch b on a.branch_id = b.branch_id
where t.amount > 50000 and not isnan(t.amount)
group by 1, 2, 3""",
    "q3r": """
select strftime(t.txn_time, '%Y%m%d%H') as bucket_hour, b.city, t.account_id, t.txn_id, t.amount
from bk_txn t join bk_account a on t.account_id = a.account_id
     join bk_branch b on a.branch_id = b.branch_id
where t.amount > 50000 and not isnan(t.amount)""",
    "q4": f"""
select e.emp_id as employee_id, {_QUARTER.format(t='t.txn_time')} as "quarter", t.txn_time,
       t.txn_id, t.account_id, t.currency, t.amount, b.branch_name
from bk_txn t join bk_employee e on t.approved_by_emp_id = e.emp_id
     join bk_branch b on e.branch_id = b.branch_id
where t.txn_type = 'Withdrawal' and t.approved_by_emp_id is not null""",
    "q5a": """
select customer_id, count(*) as account_count from bk_account where status = 'Active'
group by customer_id""",
    "q5b": f"""
select a.customer_id, {_QUARTER.format(t='t.txn_time')} as "quarter",
       cast(sum(cast(cast(t.amount as varchar) as decimal(38,12))) as double) as amount
from bk_txn t join bk_account a on t.account_id = a.account_id
group by 1, 2""",
    "q6": """
select a.branch_id, cast(extract(year from t.txn_time) as varchar) as txn_year,
       cast(t.txn_time as date) as txn_date,
       cast(sum(cast(cast(t.amount as varchar) as decimal(38,12))) as double) as total_amount, count(*) as count_txn
from bk_txn t join bk_account a on t.account_id = a.account_id
where t.status = 'approved'
group by 1, 2, 3""",
    "d6": """
select 'account_active' as event, customer_id, account_id from bk_account where status = 'Active'""",
}


def q5_sql(min_accounts: int, min_amount: float) -> str:
    """Big spenders by quarter among the customers who hold enough active accounts."""
    return f"""
select "quarter", customer_id, amount from q5b
where amount >= {min_amount}
  and customer_id in (select customer_id from bk_account where status = 'Active'
                      group by customer_id having count(*) > {min_accounts})"""


def with_mapping(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the mapping CTEs (and optional named rollups as CTEs)."""
    ctes = dict(MAPPING)
    ctes.update(extra or {})
    parts = ",\n".join(f"{name} as ({sql}\n)" for name, sql in ctes.items())
    return f"with {parts}\n{body}"


# ---------------------------------------------------------------- checks and functions
CTE_OF = {"branch": "bk_branch", "customer": "bk_customer", "employee": "bk_employee",
          "product": "bk_product", "account": "bk_account", "transaction": "bk_txn"}


def _lit_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def qc_sql(name: str) -> str:
    from ..model import DOMAINS, FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS

    parts: list[str] = []
    if name == "qc1":
        for (tb, col), dom in DOMAINS.items():
            parts.append(f"select 'QC1' as rule, '{tb}' as tbl, '{col}' as item, count(*) filter "
                         f"(where {col} is not null and {col} not in ({_lit_list(dom)})) as violations "
                         f"from {CTE_OF[tb]}")
    elif name == "qc2":
        for tb in ["branch", "customer", "employee", "product", "account", "transaction"]:
            for f in SCHEMAS[tb].fields:
                if not f.nullable:
                    parts.append(f"select 'QC2' as rule, '{tb}' as tbl, '{f.name}' as item, "
                                 f"count(*) filter (where {f.name} is null) as violations "
                                 f"from {CTE_OF[tb]}")
            if tb == "transaction":
                parts.append("select 'QC2' as rule, 'transaction' as tbl, 'amount_nan' as item, "
                             "count(*) filter (where isnan(amount)) as violations from bk_txn")
    elif name == "qc3":
        for child, ccol, parent, pcol in FOREIGN_KEYS:
            parts.append(f"select 'QC3' as rule, '{child}' as tbl, '{ccol}->{parent}.{pcol}' as item, "
                         f"count(*) as violations from {CTE_OF[child]} c where c.{ccol} is not null "
                         f"and not exists (select 1 from {CTE_OF[parent]} p where p.{pcol} = c.{ccol})")
    elif name == "qc4":
        for tb, keys in PRIMARY_KEYS.items():
            k = ", ".join(keys)
            parts.append(f"select 'QC4' as rule, '{tb}' as tbl, '{','.join(keys)}' as item, "
                         f"count(*) as violations from (select {k} from {CTE_OF[tb]} group by {k} "
                         f"having count(*) > 1)")
    elif name == "qc5":
        parts.append("select 'QC5' as rule, 'employee' as tbl, 'root' as item, "
                     "cast(abs(count(*) filter (where manager_id is null) - 1) as bigint) as violations "
                     "from bk_employee")
        parts.append("select 'QC5' as rule, 'employee' as tbl, 'manager_share' as item, "
                     "cast(abs(count(*) filter (where role = 'Manager') - "
                     "greatest(1, cast(ceil(count(*) * cast(0.10 as double)) as bigint))) as bigint) as violations "
                     "from bk_employee")
        parts.append("select 'QC5' as rule, 'employee' as tbl, 'bad_manager_link' as item, "
                     "count(*) as violations from bk_employee e where manager_id is not null and "
                     "not exists (select 1 from bk_employee m where m.role = 'Manager' "
                     "and m.emp_id = e.manager_id)")
    elif name == "qc6":
        parts.append("select 'QC6' as rule, 'account' as tbl, 'closed_at_iff_inactive' as item, "
                     "count(*) filter (where coalesce(status = 'Inactive', false) <> "
                     "(closed_at is not null)) as violations from bk_account")
    elif name == "qc7":
        parts.append("select 'QC7' as rule, 'transaction' as tbl, 'amount_range' as item, "
                     "count(*) filter (where amount < 1.0 or amount > 150000.0) as violations from bk_txn")
        parts.append("select 'QC7' as rule, 'transaction' as tbl, 'amount_two_decimals' as item, "
                     "count(*) filter (where case when not isfinite(amount) then true "
                     "else cast(cast(amount as decimal(18,2)) as double) <> amount end) "
                     "as violations from bk_txn")
    elif name == "qc8":
        from ..model import TARGET_WEIGHTS
        from ..operators.quality import target_shares

        counts = " union all ".join(
            f"select '{tb}' as tbl, '{col}' as col, {col} as value, count(*) as n "
            f"from {CTE_OF[tb]} group by {col}" for (tb, col) in TARGET_WEIGHTS)
        targets = ", ".join(f"('{tb}', '{col}', '{v}', {s!r}::double)" for tb, col, v, s in target_shares())
        return with_mapping(f"""
, counts as ({counts}),
totals as (select tbl, col, sum(n) as total from counts group by tbl, col),
observed as (select c.tbl, c.col, c.value, c.n, c.n / t.total as share
             from counts c join totals t on c.tbl = t.tbl and c.col = t.col),
targets(tbl, col, value, target) as (values {targets})
select coalesce(o.tbl, g.tbl) as tbl, coalesce(o.col, g.col) as col, coalesce(o.value, g.value) as value,
       coalesce(o.n, 0) as n, coalesce(o.share, 0.0) as share, g.target
from observed o full outer join targets g on o.tbl = g.tbl and o.col = g.col and o.value = g.value""")
    return with_mapping(" union all ".join(parts))


def _iso_utc(c: str) -> str:
    return (f"(strftime({c}, '%Y-%m-%dT%H:%M:%S') || case when epoch_us({c}) % 1000000 <> 0 "
            f"then strftime({c}, '.%f') else '' end || '+00:00')")


_UUID_OK = ("({c} is null or regexp_full_match(replace(regexp_replace(regexp_replace("
            "cast({c} as varchar), 'urn:|uuid:', '', 'g'), '^\\{{+|\\}}+$', '', 'g'), '-', ''), "
            "'[0-9a-fA-F]{{32}}'))")

FUNCTION_SQL = {
    "f9": "select account_id, opened_at, closed_at, cast(opened_at as date) as opened_on, "
          "cast(null as date) as bad_date, cast(null as timestamp) as bad_time from bk_account",
    "f10": "select account_id, strftime(cast(opened_at as date), '%Y-%m-%d') as opened_on, "
           "strftime(cast(closed_at as date), '%Y-%m-%d') as closed_on from bk_account",
    "f11": f"select account_id, {_iso_utc('opened_at')} as opened_at, {_iso_utc('closed_at')} as closed_at "
           f"from bk_account",
    "f12": " union all ".join(
        f"select '{c}' as item, count(*) filter (where {_UUID_OK.format(c=c)}) as valid, "
        f"count(*) filter (where not {_UUID_OK.format(c=c)}) as invalid from bk_txn"
        for c in ("txn_id", "account_id", "approved_by_emp_id")),
    "f14": "select customer_id, upper(substr(sha256('PAN-' || cast(customer_id as varchar)), 1, 16)) "
           "as pan_hash from bk_customer",
    # rounded as decimal text, so ties are ties
    "f17": "select txn_id, cast(round(cast(cast(greatest(1.0, least(amount * 0.125, 150000.0)) as varchar) "
           "as decimal(38,12)), 2) as double) as amount from bk_txn",
    "t7": "select * exclude (rn) from (select *, row_number() over (partition by account_id "
          "order by txn_time desc, txn_id desc) as rn from bk_txn) where rn = 1",
    "s8": "select * from bk_txn",
}

FUNCTION_SQL["s7"] = (
    "select 'banking.transactions' as topic, cast(account_id as varchar) as key, "
    "cast(json_object('txn_id', txn_id, 'account_id', cast(account_id as varchar), 'txn_type', txn_type, "
    "'amount', amount, 'currency', currency, 'txn_time', epoch_ms(txn_time), 'channel', channel, "
    "'status', status, 'product_id', cast(product_id as varchar), "
    "'approved_by_emp_id', cast(approved_by_emp_id as varchar)) as varchar) as value from bk_txn")

_TEXT_ID = "cast({c} as varchar) as {c}"
FUNCTION_SQL["s5"] = (
    f"select {_TEXT_ID.format(c='account_id')}, {_TEXT_ID.format(c='customer_id')}, account_type, status, "
    f"{_TEXT_ID.format(c='branch_id')}, {_iso_utc('opened_at')} as opened_at, {_iso_utc('closed_at')} as closed_at "
    f"from bk_account")
FUNCTION_SQL["s4"] = f"select *, 7 as n_keys from ({FUNCTION_SQL['s5']})"

FUNCTION_SQL["s8q"] = """
, sent as (select txn_id, right(txn_id, 1) as last, cast(json_object('txn_id', txn_id,
  'account_id', case when right(txn_id, 1) = '1' then 'none' else md5(cast(account_id as varchar)) end,
  'txn_type', txn_type, 'amount', amount,
  'currency', case when right(txn_id, 1) = '2' then null else currency end,
  'txn_time', epoch_ms(txn_time), 'channel', channel, 'status', status,
  'product_id', md5(cast(product_id as varchar)),
  'approved_by_emp_id', md5(cast(approved_by_emp_id as varchar))) as varchar) as value from bk_txn)
select case when last not in ('0', '1', '2') then txn_id end as txn_id,
       case last when '0' then left(value, 60) when '1' then value when '2' then value end as value,
       case last when '0' then 'unparseable record' when '1' then 'bad id account_id'
                 when '2' then 'null currency' else '' end as reason
from sent"""
