"""The registered queries once more, as SQL text over the test tables, written independently."""

from __future__ import annotations

VERSIONS = "(values (0), (1), (2)) as v(ver)"


def _change(prefix: str) -> str:
    return f"""
        cast(1000 + k * 10 + ver as varchar) as _ab_cdc_lsn,
        case when k % 11 = 0 and ver = k % 3 then timestamp '2024-06-01 00:00:00' end as _ab_cdc_deleted_at,
        timestamp '2024-01-01 00:00:00' + ver * interval 1 day as _ab_cdc_updated_at,
        '{prefix}-' || cast(k as varchar) || '-' || cast(ver as varchar) as _airbyte_raw_id,
        timestamp '2024-02-01 00:00:00' + ver * interval 1 day as _airbyte_extracted_at,
        '{{}}' as _airbyte_meta,
        cast(1 as bigint) as _airbyte_generation_id"""


RAW = {
    "raw_users": f"""
    select cast(k as varchar) as user_id, lower(c_name) || '@example.com' as email, 'Customer' as first_name,
        c_name as last_name, n_name as country,
        case when k % 2 = 0 then 'single' else 'married' end as marital_status,
        case when ver = 0 then 'pending' else 'verified' end as kyc_status,
        '2023-01-01 00:00:00' as created_at, {_change('u')}
    from (select c_custkey as k, * from customer left join nation on c_nationkey = n_nationkey)
    cross join {VERSIONS} where ver <= k % 3""",
    "raw_accounts": f"""
    select cast(k as varchar) as account_id,
        cast(case when k % 97 = 0 then k + 1000000 else k end as varchar) as user_id,
        cast(c_acctbal + ver as varchar) as balance,
        case when c_nationkey % 2 = 0 then 'USD' else 'EUR' end as currency, {_change('a')}
    from (select c_custkey as k, * from customer) cross join {VERSIONS} where ver <= k % 3""",
    "raw_transactions": f"""
    select cast(k as varchar) as transaction_id, cast(o_custkey as varchar) as from_account,
        cast((o_custkey * 7 + 3) % 150 as varchar) as to_account,
        case when k % 103 = 0 then null when k % 101 = 0 then '-1.5' else cast(o_totalprice as varchar) end as amount,
        case when k % 2 = 0 then 'transfer' else 'payment' end as "type",
        case when ver = 0 then 'pending' else 'completed' end as status,
        cast(o_orderdate as varchar) as "timestamp", {_change('t')}
    from (select o_orderkey as k, * from orders) cross join {VERSIONS} where ver <= k % 3""",
    "raw_audit": f"""
    select cast(k as varchar) as log_id, event_type as action, 'user_' || cast(user_id as varchar) as performed_by,
        cast(k % 1500 as varchar) as transaction_id, cast(ts as varchar) as "timestamp", {_change('l')}
    from (select event_id as k, * from events) cross join {VERSIONS} where ver <= k % 3""",
}

_STAGED_CHANGE = """
        cast(_ab_cdc_lsn as decimal(38, 9)) as _ab_cdc_lsn, _ab_cdc_deleted_at, _ab_cdc_updated_at,
        _airbyte_raw_id, _airbyte_extracted_at, _airbyte_meta, _airbyte_generation_id"""

STAGED = {
    "stg_users": f"""
    select cast(user_id as bigint) as user_id, email, first_name, last_name, country, marital_status, kyc_status,
        cast(created_at as timestamp) as created_at, {_STAGED_CHANGE} from raw_users""",
    "stg_accounts": f"""
    select cast(account_id as bigint) as account_id, cast(user_id as bigint) as user_id,
        cast(balance as decimal(38, 9)) as balance, currency, {_STAGED_CHANGE} from raw_accounts""",
    "stg_transactions": f"""
    select cast(transaction_id as bigint) as transaction_id, cast(from_account as bigint) as from_account_id,
        cast(to_account as bigint) as to_account_id, cast(amount as decimal(38, 9)) as amount,
        "type" as transaction_type, status, cast("timestamp" as timestamp) as transaction_timestamp,
        {_STAGED_CHANGE} from raw_transactions""",
    "stg_audit": f"""
    select cast(log_id as bigint) as log_id, action, performed_by, cast(transaction_id as bigint) as transaction_id,
        cast("timestamp" as timestamp) as event_timestamp, {_STAGED_CHANGE} from raw_audit""",
}

_CLOCKS = "_ab_cdc_updated_at as last_updated_at, _airbyte_extracted_at as ingested_at"
_BUSINESS = {
    "users": "user_id, email, first_name, last_name, country, marital_status, kyc_status, created_at",
    "accounts": "account_id, user_id, balance, currency",
    "transactions": "transaction_id, from_account_id, to_account_id, amount, transaction_type, status, transaction_timestamp",
    "audit": "log_id, action, performed_by, transaction_id, event_timestamp",
}
_KEYS = {"users": "user_id", "accounts": "account_id", "transactions": "transaction_id", "audit": "log_id"}


def _current(entity: str, source: str, live_first: bool = True) -> str:
    """Latest row per key of ``source``."""
    dead = "_ab_cdc_deleted_at is null"
    return f"""
    select {_BUSINESS[entity]}, {_CLOCKS}
    from (select *, row_number() over (partition by {_KEYS[entity]}
              order by _ab_cdc_lsn desc nulls last, _airbyte_extracted_at desc nulls last,
                       _airbyte_raw_id desc nulls last) as version_rank
          from {source} {f'where {dead}' if live_first else ''})
    where version_rank = 1 {'' if live_first else f'and {dead}'}"""


CURRENT = {
    "int_users": _current("users", "stg_users"),
    "int_accounts": _current("accounts", "stg_accounts"),
    "int_transactions": _current("transactions", "stg_transactions"),
    "int_audit": _current("audit", "stg_audit"),
}

_SEEN = "_airbyte_extracted_at <= timestamp '2024-02-01 00:00:00'"


def _facts(current: str) -> str:
    return f"""
    select t.transaction_id, t.from_account_id, t.to_account_id, s.user_id as from_user_id, r.user_id as to_user_id,
        t.amount, t.transaction_type, t.status, t.transaction_timestamp,
        cast(t.transaction_timestamp as date) as transaction_date, t.last_updated_at, t.ingested_at
    from {current} t
    left join int_accounts s on t.from_account_id = s.account_id
    left join int_accounts r on t.to_account_id = r.account_id"""


MARTS = {
    "fct_transactions": _facts("int_transactions"),
    "fct_audit": """
    select log_id, action, performed_by, transaction_id, event_timestamp,
        cast(event_timestamp as date) as event_date, last_updated_at, ingested_at from int_audit""",
    "seen_transactions": f"select * from stg_transactions where {_SEEN} and transaction_id % 5 <> 0",
    "current_seen": _current("transactions", "seen_transactions"),
    "first_load": _facts("current_seen"),
    "delta": """
    select * from fct_transactions
    where last_updated_at > (select max(last_updated_at) from first_load)
       or ingested_at > (select max(ingested_at) from first_load)""",
    "seen_audit": f"select * from stg_audit where {_SEEN} and log_id % 5 <> 0",
    "current_audit": _current("audit", "seen_audit"),
    "first_audit": """
    select log_id, action, performed_by, transaction_id, event_timestamp,
        cast(event_timestamp as date) + cast(case when log_id % 4 = 0 then 1 else 0 end as integer) as event_date,
        last_updated_at, ingested_at from current_audit""",
    "audit_delta": """
    select * from fct_audit
    where last_updated_at > (select max(last_updated_at) from first_audit)
       or ingested_at > (select max(ingested_at) from first_audit)""",
    "after_increment": """
    select * from first_load where transaction_id not in (select transaction_id from delta ) union all select * from delta""",
    "audit_changed": """
    select log_id from int_audit where last_updated_at > (select max(last_updated_at) from current_audit )
        or ingested_at > (select max(ingested_at) from current_audit )""",
    "audit_after": """
    select count(*) as n from (select log_id from current_audit union select log_id from audit_changed )""",
    "accounts_first": "select * from raw_accounts where ends_with(_airbyte_raw_id, '-0')",
    "accounts_later": "select *, cast(account_id as bigint) as k from raw_accounts where not ends_with(_airbyte_raw_id, '-0')",
    "account_deliveries": """
    select (select count(account_id) from accounts_first ) as a1, (select count(user_id) from accounts_first ) as u1,
        (select count(currency) from accounts_first ) as c1, count(account_id) as a, count(user_id) as u, count(currency) as c,
        count(*) filter (where k % 2 = 0) as s, ['account_id', 'user_id', 'currency', 'segment'] as names from accounts_later""",
    "broken_transactions": """
    select * replace (
        case when cast(transaction_id as bigint) % 211 = 0 then 'n/a' else amount end as amount,
        case when cast(transaction_id as bigint) % 223 = 0 then 'unknown' else to_account end as to_account)
    from raw_transactions""",
    "orphans": """
    select user_id, count(*) as n_records from int_accounts
    where user_id is not null and user_id not in (select user_id from int_users where user_id is not null)
    group by user_id""",
}

CTES = RAW | STAGED | CURRENT | MARTS

_DOUBLES = {
    "stg_users": ("_ab_cdc_lsn",),
    "stg_accounts": ("balance", "_ab_cdc_lsn"),
    "stg_transactions": ("amount", "_ab_cdc_lsn"),
    "stg_audit": ("_ab_cdc_lsn",),
    "int_accounts": ("balance",),
    "int_transactions": ("amount",),
    "fct_transactions": ("amount",),
    "delta": ("amount",),
    "first_load": ("amount",),
}


def _with(body: str) -> str:
    """Prefix the CTEs that ``body`` needs, in dependency order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, sql in CTES.items():
            if name not in needed and _mentions(text, name):
                needed.add(name)
                visit(sql)

    visit(body)
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in CTES.items() if name in needed)
    return f"with {ctes}\n{body}" if ctes else body


def _mentions(text: str, name: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return name in words


def _all_of(name: str, where: str = "") -> str:
    doubles = ", ".join(f"cast({c} as double) as {c}" for c in _DOUBLES.get(name, ()))
    columns = f"* replace ({doubles})" if doubles else "*"
    return f"select {columns} from {name} {where}"


_STRIPPED = "user_id, email, first_name, last_name, country, marital_status, kyc_status, created_at"

_CONTRACT = {
    "users": "user_id email first_name last_name country marital_status kyc_status created_at",
    "accounts": "account_id user_id balance currency",
    "transactions": "transaction_id from_account to_account amount type status timestamp",
    "audit": "log_id action performed_by transaction_id timestamp",
}
_ABSENT = {("accounts", "currency"), ("accounts", "_ab_cdc_lsn")}


def _contract() -> str:
    lines = []
    for table, business in _CONTRACT.items():
        for name in business.split() + ["_ab_cdc_updated_at", "_ab_cdc_deleted_at", "_ab_cdc_lsn"]:
            absent = table == "audit" or (table, name) in _ABSENT
            rows = "cast(0 as bigint)" if absent else f'(select count("{name}") from raw_{table} )'
            lines.append(
                f"select '{table}' as table_name, '{name}' as column_name, {'false' if absent else 'true'} as present,"
                f" {rows} as non_null_rows"
            )
    return " union all ".join(lines)


# column: (issue, counted in the incoming log, condition of a lost value)
_DRIFT = {
    "transaction_id": ("type_differs", "transaction_id", "try_cast(transaction_id as bigint) is null"),
    "from_account_id": ("type_differs", "from_account", "try_cast(from_account as bigint) is null"),
    "to_account": ("missing_in_second", "to_account", None),
    "amount": ("type_differs", "amount", "try_cast(amount as decimal(38, 9)) is null"),
    "type": ("missing_in_second", '"type"', None),
    "transaction_timestamp": ("type_differs", '"timestamp"', 'try_cast("timestamp" as timestamp) is null'),
    "_ab_cdc_lsn": ("missing_in_second", "_ab_cdc_lsn", None),
    "_ab_cdc_deleted_at": ("missing_in_second", "_ab_cdc_deleted_at", None),
    "_ab_cdc_updated_at": ("missing_in_second", "_ab_cdc_updated_at", None),
    "_airbyte_raw_id": ("missing_in_second", "_airbyte_raw_id", None),
    "_airbyte_extracted_at": ("missing_in_second", "_airbyte_extracted_at", None),
    "_airbyte_meta": ("missing_in_second", "_airbyte_meta", None),
    "_airbyte_generation_id": ("missing_in_second", "_airbyte_generation_id", None),
    "to_account_id": ("missing_in_first", None, None),
    "transaction_type": ("missing_in_first", None, None),
    "status": ("missing_in_first", None, None),
    "last_updated_at": ("missing_in_first", None, None),
    "ingested_at": ("missing_in_first", None, None),
}


def _drift() -> str:
    lines = []
    for name, (issue, counted, lost) in _DRIFT.items():
        held = f"(select count({counted}) from broken_transactions )" if counted else "cast(0 as bigint)"
        gone = (
            f"(select count(*) from broken_transactions where {counted} is not null and {lost})"
            if lost
            else "cast(0 as bigint)"
        )
        lines.append(
            f"select '{name}' as column_name, '{issue}' as issue, {held} as incoming_rows, {gone} as lossy_rows"
        )
    return " union all ".join(lines)


def _rule(kind: str, table: str, name: str, count: str) -> str:
    return (
        f"select '{kind}_{table}_{name}' as rule_name, '{table}' as table_name, '{name}' as column_name,"
        f" '{kind}' as rule_kind, ({count}) as failures"
    )


def _repeated(source: str, key: str) -> str:
    return (
        f"select count(*) from (select {key} from {source} where {key} is not null"
        f" group by {key} having count(*) > 1)"
    )


_NOT_NULL_RULES = [
    _rule("not_null", "dim_accounts", "account_id", "select count(*) from int_accounts where account_id is null"),
    _rule("not_null", "dim_accounts", "user_id", "select count(*) from int_accounts where user_id is null"),
    _rule("not_null", "dim_users", "user_id", "select count(*) from int_users where user_id is null"),
    _rule("not_null", "fct_transactions", "transaction_id", "select count(*) from fct_transactions where transaction_id is null"),
    _rule("not_null", "fct_transactions", "amount", "select count(*) from fct_transactions where amount is null"),
]
_OTHER_RULES = [
    _rule("unique", "dim_accounts", "account_id", _repeated("int_accounts", "account_id")),
    _rule("unique", "dim_users", "user_id", _repeated("int_users", "user_id")),
    _rule("unique", "fct_transactions", "transaction_id", _repeated("fct_transactions", "transaction_id")),
    _rule("relationships", "dim_accounts", "user_id", "select cast(coalesce(sum(n_records), 0) as bigint) from orphans"),
    _rule("accepted_range", "fct_transactions", "amount", "select count(*) from fct_transactions where amount < 0"),
]

_MERGE = f"""
select u.user_id, {', '.join(f'coalesce(u.{c}, m.{c}) as {c}' for c in
    ('email', 'first_name', 'last_name', 'country', 'marital_status', 'kyc_status', 'created_at',
     'last_updated_at', 'ingested_at'))}
from main_users m join update_users u on m.user_id = u.user_id
union all select m.* from main_users m where m.user_id not in (select user_id from update_users)
union all select u.* from update_users u where u.user_id not in (select user_id from main_users)"""

CTES |= {
    "early_users": f"select * from stg_users where {_SEEN} and country <> 'NATION_1'",
    "late_users": f"select * from stg_users where not ({_SEEN})",
    "main_users": _current("users", "early_users"),
    "newer_users": _current("users", "late_users"),
    "update_users": """
    select * replace (case when user_id % 3 <> 0 then country end as country) from newer_users""",
}

BODIES = {
    "scan_parquet": 'select "type", status, count(*) as row_count from raw_transactions group by all',
    "scan_merge_schema": f"""
    select user_id, email, first_name, last_name, country,
        case when not ({_SEEN}) then marital_status end as marital_status,
        case when not ({_SEEN}) then kyc_status end as kyc_status, created_at
    from raw_users""",
    "scan_generations": """
    select cast(account_id as bigint) as account_id, user_id, _airbyte_raw_id,
        cast(cast(case when ends_with(_airbyte_raw_id, '-0') then cast(cast(balance as decimal(12, 2)) as decimal(20, 4))
            else cast(balance as decimal(20, 4)) end as decimal(20, 4)) as varchar) as balance,
        case when not ends_with(_airbyte_raw_id, '-0') then currency end as currency
    from raw_accounts""",
    "source_views": " union all ".join(
        f"select '{name}' as source_name, count(*) as log_rows, count(distinct {key}) as key_count from raw_{name} "
        for name, key in _KEYS.items()
    ),
    "strip_metadata": f"select {_STRIPPED} from raw_users",
    "stamp_ingested_at": """
    select account_id, user_id, balance, currency, timestamp '2024-07-01 00:00:00' as ingested_at
    from raw_accounts""",
    "stg_users": _all_of("stg_users"),
    "stg_accounts": _all_of("stg_accounts"),
    "stg_transactions": _all_of("stg_transactions"),
    "stg_audit": _all_of("stg_audit"),
    "stg_transactions_exact": """
    select * replace (cast(amount as varchar) as amount, cast(_ab_cdc_lsn as varchar) as _ab_cdc_lsn)
    from stg_transactions""",
    "live_rows": _all_of("stg_transactions", "where _ab_cdc_deleted_at is null"),
    "int_users": _all_of("int_users"),
    "int_accounts": _all_of("int_accounts"),
    "int_transactions": _all_of("int_transactions"),
    "int_audit": _all_of("int_audit"),
    "int_users_rank_first": f"select * from ({_current('users', 'stg_users', live_first=False)})",
    "int_transactions_rank_first": f"""
    select * replace (cast(amount as double) as amount)
    from ({_current('transactions', 'stg_transactions', live_first=False)})""",
    "int_transactions_enriched": """
    select t.* replace (cast(t.amount as double) as amount), s.user_id as from_user_id, r.user_id as to_user_id
    from int_transactions t
    left join int_accounts s on t.from_account_id = s.account_id
    left join int_accounts r on t.to_account_id = r.account_id""",
    "merge_upsert": _MERGE,
    "resolve_collisions": """
    select coalesce(u.user_id, a.user_id) as user_id, u.email, u.first_name, u.last_name, u.country,
        u.marital_status, u.kyc_status, u.created_at,
        u.last_updated_at as user_last_updated_at, u.ingested_at as user_ingested_at,
        a.account_id, cast(a.balance as double) as balance, a.currency,
        a.last_updated_at as account_last_updated_at, a.ingested_at as account_ingested_at
    from int_users u full join int_accounts a on u.user_id = a.user_id""",
    "high_water_mark": "select max(last_updated_at) as last_updated_at, max(ingested_at) as ingested_at from first_load",
    "incremental_delta": _all_of("delta"),
    "incremental_delta_full_rank": _all_of("delta"),
    "incremental_upsert": f"""
    {_all_of('first_load', 'where transaction_id not in (select transaction_id from delta )')}
    union all {_all_of('delta')}""",
    "reconcile": """
    select c.transaction_id, case when l.transaction_id is null then 'missing' else 'stale' end as status
    from int_transactions c left join after_increment l on l.transaction_id = c.transaction_id
    where l.transaction_id is null or (c.amount, c.status, c.transaction_timestamp, c.last_updated_at, c.ingested_at)
        is distinct from (l.amount, l.status, l.transaction_timestamp, l.last_updated_at, l.ingested_at)""",
    "load_ledger": """
    select cast(1 as integer) as load_number, 'first' as load, 'full' as kind, count(*) as rows_in, count(*) as rows from current_audit
    union all select 2, 'second', 'upsert', (select count(*) from audit_changed ), n from audit_after
    union all select 3, 'third', 'upsert', 0, n from audit_after""",
    "schema_history": """
    select unnest([1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4, 5, 5, 5, 5]) as delivery,
        unnest(names[1:3] || names || names || names || names) as column_name,
        unnest(['added', 'added', 'added', 'same', 'promoted', 'same', 'added', 'same', 'narrower', 'same', 'same',
            'same', 'same', 'removed', 'same', 'changed', 'same', 'same', 'same']) as change,
        unnest(['additive', 'additive', 'additive', 'no_change', 'additive', 'no_change', 'additive', 'no_change', 'no_change', 'no_change', 'no_change',
            'no_change', 'no_change', 'breaking', 'no_change', 'breaking', 'no_change', 'no_change', 'no_change']) as verdict,
        unnest([a1, u1, c1, a, u, c, s, a, u, c, s, a, u, 0, s, a, u, c, s]) as filled_rows
    from account_deliveries""",
    "partitioned_upsert": """
    select * from first_audit where log_id not in (select log_id from audit_delta )
    union all select * from audit_delta""",
    "upsert_emptied_days": """
    select * replace (event_date + cast(day(event_date) % 2 as integer) as event_date) from fct_audit""",
    "stream_upsert": _all_of("fct_audit"),
    "dim_users": _all_of("int_users"),
    "dim_accounts": _all_of("int_accounts"),
    "fct_transactions": _all_of("fct_transactions"),
    "fct_transactions_load": f"""
    {_all_of('first_load', 'where transaction_id not in (select transaction_id from delta )')}
    union all {_all_of('delta')}""",
    "fct_audit": _all_of("fct_audit"),
    "sink_overwrite": """
    select * replace (cast(balance + 1 as double) as balance) from int_accounts""",
    "partitioned_write": """
    select event_date, action, count(*) as row_count, max(event_timestamp) as last_event
    from fct_audit group by all""",
    "row_count_metrics": " union all ".join(
        f"select '{name}' as table_name, (select count(*) from stg_{name} ) as rows_read,"
        f" (select count(*) from int_{name} ) as rows_kept"
        for name in _KEYS
    ),
    "raw_load": f"""
    select user_id, email, first_name, last_name, case when not ({_SEEN}) then country end as country,
        marital_status, kyc_status, created_at, timestamp '2024-07-01 00:00:00' as ingested_at
    from raw_users""",
    "raw_load_conflict": f"""
    select account_id, cast(user_id as bigint) as user_id, balance, currency, timestamp '2024-07-01 00:00:00' as ingested_at,
        case when {_SEEN} then 1 else 2 end as delivery
    from raw_accounts""",
    "evolving_load": """
    select user_id, email, first_name, last_name, country, cast(null as varchar) as marital_status, kyc_status,
        created_at, timestamp '2024-07-01 00:00:00' as ingested_at, upper(country) as segment
    from raw_users""",
    "harmonize_schema": """
    select user_id, email, first_name, last_name, cast(null as varchar) as country, marital_status, kyc_status,
        created_at, cast(null as timestamp) as last_updated_at, cast(null as timestamp) as ingested_at,
        upper(last_name) as segment
    from raw_users""",
    "schema_drift": _drift(),
    "schema_drift_truncation": """
    select 'account_id' as column_name, 'type_differs' as issue, count(*) as incoming_rows,
        count(*) filter (where account_id % 5 = 0) as lossy_rows from int_accounts
    union all select 'balance', 'type_differs', count(balance), count(balance) filter (where account_id % 3 = 0) from int_accounts
    union all select 'last_updated_at', 'type_differs', count(*), count(*) filter (where account_id % 2 = 1) from int_accounts
    union all select 'user_id', 'type_differs', count(user_id), count(*) filter (where user_id % 7 = 0) from int_accounts""",
    "drift_status": f"""
    select case when count(*) filter (where issue in ('missing_in_first', 'type_differs')) > 0 then 'breaking'
                when count(*) filter (where issue = 'missing_in_second') > 0 then 'additive'
                else 'no_change' end as status,
        count(*) filter (where issue <> 'none') as changed_columns, cast(sum(lossy_rows) as bigint) as lossy_rows
    from ({_drift()})""",
    "contract_check": _contract(),
    "dq_unique": """
    select transaction_id, count(*) as n_records, 'log' as table_name
    from stg_transactions where _ab_cdc_deleted_at is null and transaction_id is not null
    group by transaction_id having count(*) > 1
    union all
    select transaction_id, count(*) as n_records, 'fact' as table_name
    from fct_transactions where transaction_id is not null group by transaction_id having count(*) > 1""",
    "dq_not_null": " union all ".join(_NOT_NULL_RULES),
    "dq_accepted_range": _all_of("fct_transactions", "where amount < 0"),
    "dq_relationships": "select * from orphans",
    "dq_report": " union all ".join(_NOT_NULL_RULES + _OTHER_RULES),
    "dq_failures": """
    select 'not_null_dim_users_user_id' as rule_name, cast(null as varchar) as value from int_users where user_id is null
    union all select 'not_null_dim_accounts_account_id', null from int_accounts where account_id is null
    union all select 'not_null_dim_accounts_user_id', null from int_accounts where user_id is null
    union all select 'not_null_fct_transactions_transaction_id', null from fct_transactions where transaction_id is null
    union all select 'not_null_fct_transactions_amount', null from fct_transactions where amount is null
    union all select 'accepted_range_fct_transactions_amount', cast(cast(amount as decimal(18, 4)) as varchar)
    from fct_transactions where amount < 0
    union all select 'relationships_dim_accounts_user_id', cast(cast(user_id as decimal(18, 4)) as varchar) from orphans""",
    "quarantine_split": """
    select 'good' as verdict, "type" as item, count(*) as row_count,
        cast(sum(cast(to_account as bigint)) as bigint) as account_sum
    from broken_transactions where amount is distinct from 'n/a' and to_account <> 'unknown' group by "type"
    union all
    select 'bad', concat_ws(',', case when to_account = 'unknown' then 'to_account' end,
                                 case when amount = 'n/a' then 'amount' end) as reason, count(*), null
    from broken_transactions where amount = 'n/a' or to_account = 'unknown' group by reason""",
    "quarantine_release": """
    select 'released' as verdict, "type" as item, count(*) as row_count,
        cast(sum(case when to_account = 'unknown' then 7 else cast(nullif(to_account, 'unknown') as bigint) end) as bigint) as account_sum
    from broken_transactions
    where (amount = 'n/a' or to_account = 'unknown')
        and (to_account is distinct from 'unknown' or cast(transaction_id as bigint) % 2 = 0)
    group by "type"
    union all
    select 'left', 'to_account', count(*), null from broken_transactions
    where to_account = 'unknown' and cast(transaction_id as bigint) % 2 <> 0 having count(*) > 0
    union all
    select 'again', 'all', 0, null""",
}

ORACLES = {name: _with(body) for name, body in BODIES.items()}
