"""The registered queries once more, as SQL for a second engine.

Written from the semantics, not from the Spark plans, so that the two sides can
disagree. Every statement starts from the given tables.
"""

from __future__ import annotations

RAW_TRANSACTIONS = """
raw_orders as (
 select o_orderkey as k, o_custkey as c, cast(o_orderdate as date) as d, o_totalprice as p, o_orderstatus as s, o_orderpriority as pr,
  case (o_orderkey*7+o_custkey)%10 when 0 then 'Salary' when 1 then 'Investment' when 2 then 'Transfer' when 3 then 'Rent' when 4 then 'Groceries'
   when 5 then 'Utilities' when 6 then 'Healthcare' when 7 then 'Travel' when 8 then 'Entertainment' else 'Miscellaneous' end as cat
 from orders),
raw_sent as (
 select k, k as tid, c,d,p,s,pr,cat, 0 as dup from raw_orders
 union all
 select k, k+1000000007 as tid, c,d, case when k%50=31 then p+0.01 else p end as p, s,pr,cat, 1 as dup from raw_orders where k%25=6),
raw_transactions as (
select tid as transaction_id,
 case when k%80=11 then -1 when k%160=51 then 999999999 else c end as account_id,
 case when k%70=5 then '' when k%210=17 then '1999-02-30'
  when tid%4=0 then cast(year(d) as varchar(4))||'-'||lpad(cast(month(d) as varchar(2)),2,'0')||'-'||lpad(cast(day(d) as varchar(2)),2,'0')
  when tid%4=1 then lpad(cast(month(d) as varchar(2)),2,'0')||'/'||lpad(cast(day(d) as varchar(2)),2,'0')||'/'||cast(year(d) as varchar(4))
  when tid%4=2 then lpad(cast(day(d) as varchar(2)),2,'0')||'-'||lpad(cast(month(d) as varchar(2)),2,'0')||'-'||cast(year(d) as varchar(4))
  else lpad(cast(month(d) as varchar(2)),2,'0')||'-'||lpad(cast(day(d) as varchar(2)),2,'0')||'-'||cast(year(d) as varchar(4)) end as transaction_date,
 case when k%60=9 then '' when k%7=1 then upper(cat) when k%7=2 then lower(cat) when k%13=3 then '  '||cat||'  ' else cat end as category,
 case when k%65=12 then null when k%40=8 then -p else p end as amount,
 case when k%75=20 then null when k%9=4 then upper(case when cat in ('Salary','Transfer','Investment') then 'credit' else 'debit' end)
   when cat in ('Salary','Transfer','Investment') then 'credit' else 'debit' end as transaction_type,
 case when k%14=0 then '  ' else '' end || cat || ' - ' || pr as description,
 case when k%50=1 then case k%400 when 1 then 'DONE' when 51 then 'complete' when 101 then 'Compleeted' when 151 then 'nil' when 201 then 'NULL' when 251 then 'unknown' when 301 then '3' else 'yes' end
   when dup=0 and k%100=6 then 'unknown' when k%11=2 then upper(case s when 'P' then 'pending' when 'F' then 'failed' else 'completed' end)
   else case s when 'P' then 'pending' when 'F' then 'failed' else 'completed' end end as status
from raw_sent)"""

RAW_ACCOUNTS = """
raw_customers as (
 select c_custkey as k, c_name as nm, c_mktsegment as seg, r_name as rg,
  date '2020-01-01' + cast(c_custkey % 1000 as int) as d
 from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
raw_accounts as (
select k as account_id,
 case when k%4=1 then '  '||nm else nm end as customer_name,
 case when k%5=2 then lower(seg) else seg end as account_type,
 case when k%3=1 then lower(rg) else rg end as region,
 case k%4 when 0 then cast(year(d) as varchar(4))||'-'||lpad(cast(month(d) as varchar(2)),2,'0')||'-'||lpad(cast(day(d) as varchar(2)),2,'0')
  when 1 then lpad(cast(month(d) as varchar(2)),2,'0')||'/'||lpad(cast(day(d) as varchar(2)),2,'0')||'/'||cast(year(d) as varchar(4))
  when 2 then lpad(cast(day(d) as varchar(2)),2,'0')||'-'||lpad(cast(month(d) as varchar(2)),2,'0')||'-'||cast(year(d) as varchar(4))
  else lpad(cast(month(d) as varchar(2)),2,'0')||'-'||lpad(cast(day(d) as varchar(2)),2,'0')||'-'||cast(year(d) as varchar(4)) end as created_date
from raw_customers)"""


def title_case(text: str) -> str:
    words = f"string_split(lower({text}), ' ')"
    return f"array_to_string(list_transform({words}, lambda z: upper(z[1:1]) || z[2:]), ' ')"


def parse_date(text: str) -> str:
    dash = rf"regexp_matches({text}, '^\d{{2}}-\d{{2}}-\d{{4}}$')"
    return rf"""cast(case
      when regexp_matches({text}, '^\d{{4}}-\d{{2}}-\d{{2}}$') then try_strptime({text}, '%Y-%m-%d')
      when regexp_matches({text}, '^\d{{2}}/\d{{2}}/\d{{4}}$') then try_strptime({text}, '%m/%d/%Y')
      when {dash} and substr({text}, 1, 2) > '12' then try_strptime({text}, '%d-%m-%Y')
      when {dash} then try_strptime({text}, '%m-%d-%Y') end as date)"""


def total(amount: str) -> str:
    return f"cast(round(sum(cast({amount} as decimal(28,6))), 2) as double)"


CLEANED = f"""
trimmed as (
 select transaction_id, account_id, transaction_date as raw_date, trim(transaction_date) as day_text,
  {title_case("trim(category)")} as category, trim(description) as description,
  lower(trim(transaction_type)) as transaction_type, trim(status) as raw_status, case when abs(amount) < 1e15 then amount end as fit_amount
 from raw_transactions),
dated as (
 select *, {parse_date("day_text")} as transaction_date from trimmed),
cleaned as (
 select transaction_id, account_id, raw_date, transaction_date,
  coalesce(regexp_matches(day_text, '^\\d{{2}}-\\d{{2}}-\\d{{4}}$') and substr(day_text, 1, 2) <= '12'
   and substr(day_text, 4, 2) <= '12' and transaction_date is not null, false) as _date_ambiguous,
  category, abs(fit_amount) as amount, coalesce(fit_amount < 0, false) as _amount_corrected, transaction_type, description,
  raw_status,
  case when lower(raw_status) in ('completed', 'complete', 'done') then 'completed'
   when lower(raw_status) in ('pending', 'failed') then lower(raw_status) end as status
 from dated)"""

LABELLED = """
ranked as (
 select *, cast(row_number() over (partition by account_id, transaction_date, amount, category order by transaction_id) as integer) as _dedup_rank,
  not exists (select 1 from raw_accounts a where a.account_id = cleaned.account_id) as _orphaned_account
 from cleaned),
labelled as (
 select *, case when transaction_date is null then 'NULL_DATE'
   when transaction_date < date '1995-01-01' or transaction_date > date '2000-12-31' then 'OUT_OF_RANGE_DATE'
   when category is null or category = '' then 'NULL_CATEGORY' when amount is null then 'NULL_AMOUNT'
   when transaction_type is null then 'NULL_TRANSACTION_TYPE' when status is null then 'INVALID_STATUS'
   when _orphaned_account then 'ORPHANED_ACCOUNT_ID' when _dedup_rank > 1 then 'DUPLICATE' end as _rejection_reason
 from ranked),
clean as (select * from labelled where _rejection_reason is null)"""

DIMENSIONS = f"""
spine as (
 select cast(unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-31', interval 1 day)) as date) as full_date),
dim_date as (
 select strftime(full_date, '%Y%m%d') as date_key, full_date, dayname(full_date) as day_of_week,
  cast(day(full_date) as integer) as day_of_month, cast(dayofyear(full_date) as integer) as day_of_year,
  cast(weekofyear(full_date) as integer) as week_of_year, cast(month(full_date) as integer) as month_num,
  monthname(full_date) as month_name, cast(quarter(full_date) as integer) as quarter, cast(year(full_date) as integer) as year,
  dayofweek(full_date) in (0, 6) as is_weekend, full_date = last_day(full_date) as is_month_end,
  day(full_date) = 1 as is_month_start
 from spine),
dim_accounts as (
 select sha256(cast(account_id as varchar)) as account_key, account_id, trim({title_case("customer_name")}) as customer_name,
  trim({title_case("account_type")}) as account_type, trim({title_case("region")}) as region,
  {parse_date("trim(created_date)")} as created_date
 from raw_accounts),
categories(category_name, category_group, category_type) as (values
 ('Salary', 'Income', 'Inflow'), ('Investment', 'Income', 'Inflow'), ('Transfer', 'Income', 'Inflow'),
 ('Rent', 'Essential', 'Outflow'), ('Groceries', 'Essential', 'Outflow'), ('Utilities', 'Essential', 'Outflow'),
 ('Healthcare', 'Essential', 'Outflow'), ('Travel', 'Discretionary', 'Outflow'),
 ('Entertainment', 'Discretionary', 'Outflow'), ('Miscellaneous', 'Discretionary', 'Outflow')),
dim_category as (select sha256(lower(category_name)) as category_key, * from categories),
facts as (
 select sha256(cast(transaction_id as varchar)) as transaction_key, sha256(cast(account_id as varchar)) as account_key,
  strftime(transaction_date, '%Y%m%d') as date_key, sha256(lower(category)) as category_key,
  amount, transaction_type, status, _amount_corrected, _date_ambiguous
 from clean)"""


def over_raw(body: str) -> str:
    return f"with {RAW_TRANSACTIONS} {body}"


def over_cleaned(body: str) -> str:
    return f"with {RAW_TRANSACTIONS}, {CLEANED} {body}"


def over_labelled(body: str, extra: str = "") -> str:
    extra = f", {extra}" if extra else ""
    return f"with {RAW_TRANSACTIONS}, {RAW_ACCOUNTS}, {CLEANED}, {LABELLED}{extra} {body}"


# Rows as they arrive in two lots: of the valid ones of a key the first stays.
SETTLED_WITH = """
settled as (
 select *, case when not valid then _rejection_reason
   when row_number() over (partition by account_id, transaction_date, amount, category, valid
     order by transaction_id >= 1000000007, transaction_id) > 1 then 'DUPLICATE' end as reason
 from (select *, _rejection_reason is null or _rejection_reason = 'DUPLICATE' as valid from labelled))"""


# Every third accepted transaction moved to one account.
BUSY = "busy as (select * replace (case when transaction_id % 3 = 0 then 3 else account_id end as account_id) from clean)"


def over_star(body: str, extra: str = "") -> str:
    extra = f", {extra}" if extra else ""
    return f"with {RAW_TRANSACTIONS}, {RAW_ACCOUNTS}, {CLEANED}, {LABELLED}, {DIMENSIONS}{extra} {body}"


BRONZE = """select transaction_id, account_id, nullif(transaction_date, '') as transaction_date,
 nullif(category, '') as category, amount, transaction_type, description, status,
 'transactions_raw.csv' as _source_file from raw_transactions"""

YEAR_MONTH = "cast(year as varchar) || '-' || lpad(cast(month_num as varchar), 2, '0') as year_month"

BUDGET = """
budget as (
 select case when month_num % 5 = 2 then upper(category_name) else category_name end as category,
  month_num as month, year, cast(1000 + 10 * month_num as double) as budget_amount
 from categories, (select distinct year, month_num from dim_date where year in (1999, 2000))
 where category_type = 'Outflow')"""

SNAPSHOTS = """
snapshots as (
 select account_id, customer_name, region, cast(2020 + n as varchar) as taken, make_date(2020 + n, 1, 1) as snapshot_date,
  case when account_id % 10 = 3 and n >= 1 then 'PREMIER' when account_id % 10 = 4 and n = 1 then 'PREMIER' else account_type end as account_type
 from raw_accounts, (select unnest(generate_series(0, 2)) as n)),
changes as (
 select *, lag(snapshot_date) over w as before, lag(account_type) over w as old_type, lag(region) over w as old_region,
  lag(customer_name) over w as old_name
 from snapshots window w as (partition by account_id order by snapshot_date)),
versions as (
 select * from changes where before is null or account_type is distinct from old_type
  or region is distinct from old_region or customer_name is distinct from old_name)"""

SQL: dict[str, str] = {
    "bronze_transactions": over_raw(BRONZE),
    "incremental_ingest": over_raw(BRONZE),
    "incremental_clean": over_labelled(
        """select transaction_id, account_id, transaction_date, category, amount, transaction_type, description, status,
        _date_ambiguous, _amount_corrected from settled where reason is null""", SETTLED_WITH
    ),
    "incremental_quarantine": over_labelled(
        "select transaction_id, account_id, transaction_date, amount, nullif(category, '') as category, reason as _rejection_reason from settled where reason is not null", SETTLED_WITH
    ),
    "incremental_settled": over_labelled(
        "select transaction_id, account_id, transaction_date, amount, nullif(category, '') as category, reason as _rejection_reason from settled",
        SETTLED_WITH.replace(
            "transaction_id >= 1000000007, transaction_id", "case when transaction_id >= 1000000007 then 1 else transaction_id % 2 * 2 end, transaction_id"
        ),
    ),
    "quarantine_replay": over_labelled(
        "select transaction_id, account_id, transaction_date, amount, nullif(category, '') as category, reason as _rejection_reason from settled",
        SETTLED_WITH.replace("transaction_id >= 1000000007, transaction_id", "transaction_id"),
    ),
    "merge_accounts": f"""with {RAW_ACCOUNTS},
        base as (select account_id, trim(customer_name) as name, upper(account_type) as account_type, upper(region) as region from raw_accounts),
        opened as (select account_id + 10000000 as account_id, name, account_type, region from base where account_id % 50 = 7),
        states as (
         select *, 1 as version, '' as label from base
         union all select *, 2, ' renamed' from base where account_id % 10 = 3
         union all select *, 1, '' from opened
         union all select *, 0, ' stale' from base where account_id % 10 = 6
         union all select *, 3, ' twice' from base where account_id % 20 = 3
         union all select *, 4, ' thrice' from base where account_id % 20 = 3
         union all select *, 5, ' kept' from opened where account_id % 100 = 7)
        select account_id, name || label as customer_name, account_type, region, cast(version as bigint) as version from states
        qualify row_number() over (partition by account_id order by version desc) = 1""",
    "spend_by_region_as_of": over_labelled(
        f"""select v.region, v.account_type, {total("amount")} as total_spend, count(*) as transaction_count
        from busy f left join versions v on v.account_id = f.account_id and v.snapshot_date <= f.transaction_date
         and (v.until is null or f.transaction_date < v.until)
        where transaction_type = 'debit' group by 1, 2""",
        f"""{BUSY}, taken as (
         select account_id, upper(account_type) as account_type,
          case when account_id % 10 = 3 and n >= 1 then 'EUROPE' when account_id % 10 = 4 and n = 1 then 'ASIA' else upper(region) end as region,
          case n when 0 then date '1995-06-01' when 1 then date '1997-01-15' else date '1999-03-31' end as snapshot_date
         from raw_accounts, (select unnest([0, 1, 2]) as n) where account_id % 7 <> 5 or n > 0),
        marked as (
         select *, lag(snapshot_date) over w is null or (region, account_type) is distinct from (lag(region) over w, lag(account_type) over w) as starts
         from taken window w as (partition by account_id order by snapshot_date)),
        versions as (
         select *, lead(snapshot_date) over (partition by account_id order by snapshot_date) as until from marked where starts)""",
    ),
    "near_repeats": over_labelled(
        """select l.account_id, l.first_id as left_id, r.first_id as right_id, l.n as left_rows, r.n as right_rows,
        cast(date_diff('day', l.transaction_date, r.transaction_date) as integer) as days_apart,
        cast(round(r.exact - l.exact, 2) as double) as amount_apart
        from classes l join classes r on l.account_id = r.account_id and l.first_id < r.first_id
         and abs(date_diff('day', l.transaction_date, r.transaction_date)) <= 1 and abs(l.exact - r.exact) <= 0.01""",
        """classes as (
         select account_id, transaction_date, amount, cast(amount as decimal(28,6)) as exact, category, min(transaction_id) as first_id, count(*) as n
         from labelled where _rejection_reason is null or _rejection_reason = 'DUPLICATE' group by all)""",
    ),
    "rolling_spend": over_labelled(
        """select transaction_id, account_id, transaction_date,
        cast(round(sum(case when transaction_type = 'debit' then cast(amount as decimal(28,6)) else 0 end) over (
         partition by account_id order by transaction_date range between interval 29 days preceding and current row), 2) as double) as spend_30d,
        cast(round(sum(case transaction_type when 'credit' then cast(amount as decimal(28,6)) when 'debit' then -cast(amount as decimal(28,6)) else 0 end) over (
         partition by account_id order by transaction_date, transaction_id rows unbounded preceding), 2) as double) as balance
        from busy""",
        BUSY,
    ),
    "spend_cube": over_star(
        f"""select case grouping(year, month_num, category_group, category_name, region, account_type, status)
          when 15 then 'monthly_spend_trend' when 39 then 'spend_by_category' when 121 then 'spend_by_region'
          when 31 then 'income_vs_outflow' when 126 then 'status_breakdown' end as report,
         year, month_num, category_group, category_name, region, account_type, status,
         {total("case when transaction_type = 'debit' then amount else 0 end")} as total_spend,
         {total("case when transaction_type = 'credit' then amount else 0 end")} as total_income,
         {total("amount")} as total_amount, count(*) filter (transaction_type = 'debit') as debit_count, count(*) as transaction_count
        from facts join dim_date using (date_key) join dim_category using (category_key) left join dim_accounts using (account_key)
        group by grouping sets ((year, month_num, category_group), (year, category_group, category_name), (region, account_type), (year, month_num), (status))"""
    ),
    "spend_of_quarter": over_star(
        f"""select date_key, {total("amount")} as total_spend, count(*) as transaction_count
        from facts join dim_date using (date_key) where transaction_type = 'debit' and year = 1998 and quarter = 2 group by date_key"""
    ),
    "contract_drift": over_labelled(
        """select 'no_shift' as contract, subject, value, value < 0.2 as passed from (
         select subject, round(sum((p - q) * ln(p / q)), 6) as value from (
          select subject, (n + 0.5) / (sum(n) over s + 0.5 * count(*) over s) as p, (m + 0.5) / (sum(m) over s + 0.5 * count(*) over s) as q
          from bins window s as (partition by subject)) group by subject)
        union all select 'unique', 'transaction_id', cast(count(*) - count(distinct transaction_id) as double), count(*) = count(distinct transaction_id) from later
        union all select 'known', 'account_id', round(lost / total, 6), lost = 0 from (
         select count(*) filter (not exists (select 1 from raw_accounts a where a.account_id = l.account_id)) as lost, count(*) as total from later l)""",
        """later_once as (
         select * replace (case when transaction_id % 3 <> 0 then 'Travel' else category end as category,
          case when transaction_id % 41 = 0 then -5 else account_id end as account_id) from clean where transaction_id % 2 = 1),
        later as (select * from later_once union all select * from later_once where transaction_id % 97 = 0),
        both_runs as (select *, 1 as is_now from later union all select *, 0 from clean where transaction_id % 2 = 0),
        bins as (
         select subject, bin, sum(is_now) as n, sum(1 - is_now) as m from (
          select is_now, unnest(['category', 'status', 'amount', 'month']) as subject,
           unnest([category, status, cast(floor(amount / 50000) as varchar), cast(month(transaction_date) as varchar)]) as bin from both_runs)
         group by subject, bin)""",
    ),
    "accounts_by_period": over_labelled(
        """select grain, period, count(distinct account_id) as accounts, true as sketch_within_bound from (
         select account_id, unnest(['month', 'quarter', 'year']) as grain,
          unnest([strftime(transaction_date, '%Y-%m'), year(transaction_date) || '-Q' || quarter(transaction_date), cast(year(transaction_date) as varchar)]) as period
         from clean) group by grain, period"""
    ),
    "bronze_accounts": f"with {RAW_ACCOUNTS} select *, 'accounts_raw.csv' as _source_file from raw_accounts",
    "text_standardise": over_cleaned(
        "select transaction_id, category, description, transaction_type, raw_status as status from cleaned"
    ),
    "mixed_date_parse": over_cleaned(
        "select transaction_id, raw_date, transaction_date as parsed_date, _date_ambiguous as date_ambiguous from cleaned"
    ),
    "status_canonicalise": over_cleaned(
        "select raw_status, status, count(*) as transactions from cleaned group by raw_status, status"
    ),
    "amount_correct": over_cleaned("select transaction_id, amount, _amount_corrected from cleaned"),
    "dedup_rank": over_labelled(
        "select transaction_id, account_id, transaction_date, amount, category, _dedup_rank from labelled"
    ),
    "orphan_accounts": over_labelled("select transaction_id, account_id, _orphaned_account from labelled"),
    "rejection_reason": over_labelled("select transaction_id, _rejection_reason from labelled"),
    "silver_clean": over_labelled(
        """select transaction_id, account_id, transaction_date, category, amount, transaction_type, description, status,
        'transactions_raw.csv' as _source_file, _date_ambiguous, _amount_corrected from clean"""
    ),
    "silver_quarantine": over_labelled(
        """select transaction_id, account_id, transaction_date, category, amount, transaction_type, description, status,
        'transactions_raw.csv' as _source_file, _date_ambiguous, _amount_corrected, _dedup_rank, _orphaned_account,
        _rejection_reason from labelled where _rejection_reason is not null"""
    ),
    "quarantine_breakdown": over_labelled(
        'select _rejection_reason, count(*) as "count" from labelled where _rejection_reason is not null group by 1'
    ),
    "dq_summary": over_labelled(
        """select count(*) as bronze_rows, count(*) filter (_rejection_reason is null) as clean_rows,
        count(*) filter (_rejection_reason is not null) as rejected_rows,
        round(100.0 * count(*) filter (_rejection_reason is null) / count(*), 1) as clean_pct,
        round(100.0 * count(*) filter (_rejection_reason is not null) / count(*), 1) as rejected_pct from labelled"""
    ),
    "dim_date": over_star(
        """select d.*, coalesce(f.n, 0) as fact_rows from dim_date d
        left join (select date_key, count(*) as n from facts group by date_key) f on d.date_key = f.date_key"""
    ),
    "dim_category": over_star(
        """select c.*, coalesce(f.n, 0) as fact_rows from dim_category c
        left join (select category_key, count(*) as n from facts group by category_key) f on c.category_key = f.category_key"""
    ),
    "dim_accounts": over_star("select * from dim_accounts"),
    "null_key_audit": over_star(
        """select count(*) filter (account_id is null) as null_account_id,
        count(*) filter (account_key is null) as null_account_key from dim_accounts"""
    ),
    "surrogate_keys": over_star(
        """select transaction_id, sha256(cast(transaction_id as varchar)) as transaction_key,
        sha256(cast(account_id as varchar)) as account_key, sha256(lower(category)) as category_key from clean"""
    ),
    "fct_transactions": over_star("select * from facts"),
    "stored_run": over_star("select * from facts"),
    "fk_audit": over_star(
        """select count(*) filter (not exists (select 1 from dim_accounts a where a.account_key = f.account_key)) as orphaned_accounts,
        count(*) filter (not exists (select 1 from dim_date d where d.date_key = f.date_key)) as orphaned_dates,
        count(*) filter (not exists (select 1 from dim_category c where c.category_key = f.category_key)) as orphaned_categories
        from facts f"""
    ),
    "fk_audit_all_rows": over_star(
        """select count(*) filter (not exists (select 1 from dim_accounts a where a.account_key = f.account_key)) as orphaned_accounts,
        count(*) filter (not exists (select 1 from dim_date d where d.date_key = f.date_key)) as orphaned_dates,
        count(*) filter (not exists (select 1 from dim_category c where c.category_key = f.category_key)) as orphaned_categories
        from (select sha256(cast(account_id as varchar)) as account_key, strftime(transaction_date, '%Y%m%d') as date_key,
         sha256(lower(category)) as category_key from labelled) f"""
    ),
    "monthly_spend_trend": over_star(
        f"""select year, month_num, month_name, {YEAR_MONTH}, category_group, {total("amount")} as total_spend,
        count(*) as transaction_count
        from facts join dim_date using (date_key) join dim_category using (category_key)
        where transaction_type = 'debit' and year in (1999, 2000)
        group by year, month_num, month_name, category_group"""
    ),
    "spend_by_category": over_star(
        f"""select category_group, category_name, year, {total("amount")} as total_spend, count(*) as transaction_count,
        ((2 * cast(sum(cast(amount as decimal(18,2))) * 100 as hugeint) + count(*)) // (2 * count(*))) / 100.0 as avg_transaction
        from facts join dim_date using (date_key) join dim_category using (category_key)
        where transaction_type = 'debit' group by category_group, category_name, year"""
    ),
    "spend_by_region": over_star(
        f"""select region, account_type, {total("amount")} as total_spend, count(*) as transaction_count,
        count(distinct account_key) as unique_accounts
        from facts join dim_accounts using (account_key) where transaction_type = 'debit' group by region, account_type"""
    ),
    "income_vs_outflow": over_star(
        f"""select year, month_num, {YEAR_MONTH},
        {total("case when transaction_type = 'credit' then amount else 0 end")} as total_income,
        {total("case when transaction_type = 'debit' then amount else 0 end")} as total_outflow,
        {total("case transaction_type when 'credit' then amount when 'debit' then -amount else 0 end")} as net_position
        from facts join dim_date using (date_key) group by year, month_num"""
    ),
    "status_breakdown": over_star(
        f"select status, count(*) as transaction_count, {total('amount')} as total_amount from facts group by status"
    ),
    "total_transactions": over_star("select count(*) as total_transactions from facts"),
    "total_spend": over_star(f"select {total('amount')} as total_spend from facts where transaction_type = 'debit'"),
    "clean_data_pct": over_labelled(
        """select round((select count(*) from clean) * 100.0 / (select count(*) from raw_transactions), 2) as clean_data_pct"""
    ),
    "layer_reconciliation": over_star(
        """select 'bronze' as layer, count(*) as rows from raw_transactions
        union all select 'silver_clean', count(*) from clean
        union all select 'silver_quarantine', count(*) from labelled where _rejection_reason is not null
        union all select 'gold_fact', count(*) from facts"""
    ),
    "budget_vs_actual": over_star(
        f"""select coalesce(s.year, b.year) as year, coalesce(s.month_num, b.month_num) as month_num,
        coalesce(s.category_name, b.category_name) as category_name, b.planned as budget_amount, s.spent as actual_amount,
        round(coalesce(s.spent, 0) - coalesce(b.planned, 0), 2) as variance
        from (select year, month_num, category_name, {total("amount")} as spent
          from facts join dim_date using (date_key) join dim_category using (category_key)
          where transaction_type = 'debit' group by year, month_num, category_name) s
        full join (select year, month as month_num, {title_case("category")} as category_name, {total("budget_amount")} as planned
          from budget group by 1, 2, 3) b
        on s.year = b.year and s.month_num = b.month_num and s.category_name = b.category_name""",
        BUDGET,
    ),
    "account_history": f"""with {RAW_ACCOUNTS}, {SNAPSHOTS}
        select sha256(cast(account_id as varchar) || '|' || cast(snapshot_date as varchar)) as account_version_key,
        sha256(cast(account_id as varchar)) as account_key, account_id, customer_name, account_type, region,
        cast(row_number() over v as integer) as version, snapshot_date as valid_from,
        cast(lead(snapshot_date) over v - interval 1 day as date) as valid_to, lead(snapshot_date) over v is null as is_current
        from versions window v as (partition by account_id order by snapshot_date)""",
    "contract_report": over_labelled(
        """select contract, checked_rows, failed_rows, failed_rows = 0 as passed from (
        select count(*) as checked_rows,
         unnest(['amount_not_negative', 'category_known', 'date_in_bounds', 'date_unambiguous', 'status_canonical', 'type_credit_or_debit']) as contract,
         unnest([count(*) filter (not coalesce(amount >= 0, false)),
          count(*) filter (not coalesce(category in ('Salary', 'Investment', 'Transfer', 'Rent', 'Groceries', 'Utilities', 'Healthcare', 'Travel', 'Entertainment', 'Miscellaneous'), false)),
          count(*) filter (not coalesce(transaction_date between date '1995-01-01' and date '2000-12-31', false)),
          count(*) filter (_date_ambiguous),
          count(*) filter (not coalesce(status in ('completed', 'pending', 'failed'), false)),
          count(*) filter (not coalesce(transaction_type in ('credit', 'debit'), false))]) as failed_rows
        from labelled)"""
    ),
}
