"""DuckDB oracles for the catalogue: one SQL string per query name.

The fixture views of FIXTURES.md §B are inlined as CTEs over the raw tables
(the checker registers only those).  Money is computed in integer cents
(HUGEINT), because DuckDB divides decimals as doubles; rounding is half-up.
The oracles state each rule directly (running sums, row_number, exists), not
the formulations the Spark operators use.
"""

from __future__ import annotations

FIXTURE_CTES = {
    "order_detail_raw": """
select l_orderkey * 10 + l_linenumber as id, l_orderkey as order_id, l_partkey as sku_id,
       l_extendedprice as order_price, cast(l_quantity as bigint) as sku_num,
       p_name as sku_name, l_suppkey as tie_break,
       l_orderkey * 60 + ((l_orderkey * 10 + l_linenumber) * 7 % 41) - 20 as arrive_s
from lineitem join part on l_partkey = p_partkey""",
    "order_detail": """
select id, order_id, sku_id, order_price, sku_num, sku_name, arrive_s
from (select *, row_number() over (partition by order_id, id
             order by sku_id, tie_break, order_price, sku_num) as rn
      from order_detail_raw) x
where rn = 1""",
    "order_tot": """
select order_id,
       sum(cast(order_price as decimal(12,2)) * cast(sku_num as decimal(6,0))) as original_total_amount
from order_detail group by order_id""",
    "order_info": """
select o_orderkey as id, cast(c_nationkey as bigint) as province_id,
       o_orderstatus as order_status, o_custkey as user_id,
       o_totalprice as final_total_amount,
       cast(coalesce(original_total_amount, 0) as double) as original_total_amount,
       concat(substr(cast(o_orderdate as string), 1, 10), ' ',
              lpad(cast(o_orderkey % 24 as string), 2, '0'), ':',
              lpad(cast(o_orderkey % 60 as string), 2, '0'), ':00') as create_time,
       o_orderkey * 60 as arrive_s
from orders join customer on o_custkey = c_custkey
left join order_tot on order_id = o_orderkey""",
    "user_info": """
select cast(c_custkey as string) as id, c_name as name,
       concat(cast(1940 + c_custkey % 85 as string), '-06-15') as birthday,
       case c_custkey % 3 when 0 then 'F' when 1 then 'M' else 'U' end as gender
from customer where c_custkey % 11 <> 0""",
    "province_info": """
select cast(n_nationkey as string) as id, n_name as name,
       cast(100000 + 10000 * n_nationkey as string) as area_code,
       concat('X', cast(n_nationkey as string)) as iso_code,
       concat('XX-', cast(n_nationkey as string)) as iso_3166_2
from nation where n_nationkey <> 7""",
    "sku_info": """
select cast(p_partkey as string) as id,
       cast(min(p_partkey) over (partition by p_name) as string) as spu_id,
       cast(p_retailprice as string) as price, p_name as sku_name,
       substr(p_brand, 7) as tm_id,
       cast(min(p_partkey) over (partition by p_type) as string) as category3_id
from part""",
    "spu_info": """
select cast(min(p_partkey) as string) as id, p_name as spu_name from part group by p_name""",
    "trademark_info": """
select distinct substr(p_brand, 7) as tm_id, p_brand as tm_name from part""",
    "category3_info": """
select cast(min(p_partkey) as string) as id, p_type as name from part group by p_type""",
    "app_log": """
select event_id, concat('mid_', cast(user_id as string)) as mid, cast(user_id as string) as uid,
       event_type as ch, cast(user_id % 25 as string) as ar, 'v1' as vc, ts,
       event_type in ('view', 'signup') as has_start
from events""",
}

# Oracle-only helper views (stated from the reference's rules).
HELPER_CTES = {
    "start_log": """
select event_id, mid, uid, ar, ch, vc,
       concat(cast(year(ts) as varchar), '-', cast(month(ts) as varchar), '-', cast(day(ts) as varchar)) as dt,
       cast(hour(ts) as varchar) as hr, cast(minute(ts) as varchar) as mi, epoch_us(ts) // 1000 as ts,
       strftime(ts, '%Y%m%d') as day
from app_log where has_start""",
    "dau": """
select * from (select *, row_number() over (partition by mid, day order by ts, event_id) as rn from start_log) x
where rn = 1""",
    "wide_base": """
select i.id as order_id, d.id as order_detail_id, i.create_time, substr(i.create_time, 1, 10) as dt,
       i.final_total_amount, i.original_total_amount, d.order_price, d.sku_num,
       cast(round(i.final_total_amount * 100) as hugeint) as fc,
       cast(round(d.order_price * 100) as hugeint) * d.sku_num as lc,
       cast(round(i.original_total_amount * 100) as hugeint) as tc
from order_info i join order_detail d on i.id = d.order_id""",
    "window_pairs": """
select i.id as order_id, d.id as order_detail_id,
       cast(round(i.final_total_amount * 100) as hugeint) as fc,
       cast(round(d.order_price * 100) as hugeint) * d.sku_num as lc,
       cast(round(i.original_total_amount * 100) as hugeint) as tc
from order_info i join order_detail d
  on i.id = d.order_id and abs(floor(i.arrive_s / 5) - floor(d.arrive_s / 5)) <= 2""",
    "order_span": "select max(arrive_s) as span from order_info",
    "info_delivered": """
select id, arrive_s, cast(least(4, greatest(0, arrive_s * 5 // span)) + case when id % 11 = 0 then 1 else 0 end as integer) as batch
from order_info, order_span""",
    "detail_delivered": """
select id, order_id, arrive_s, cast(least(4, greatest(0, arrive_s * 5 // span)) + case when id % 11 = 0 then 1 else 0 end as integer) as batch
from (select id, order_id, arrive_s + case when id % 13 = 0 then 1000 else 0 end as arrive_s from order_detail) d, order_span""",
    **{f"{f}_batches": f"select batch, max(arrive_s) as high from {f}_delivered group by batch" for f in ("info", "detail")},
    **{f"{f}_gated": f"""
select f.*, coalesce(f.arrive_s <= (select max(b.high) from {f}_batches b where b.batch < f.batch) - 600, false) as late
from {f}_delivered f""" for f in ("info", "detail")},
    # cent shares; the last line with an amount (running sum = total) takes final - shares before it
    "cents_wide": """
select *, case when completes then fc - coalesce(before_c, 0) else share_c end as value_c
from (select *, running = tc and lc <> 0 as completes,
             sum(share_c) over (partition by order_id order by order_detail_id
                                rows between unbounded preceding and 1 preceding) as before_c
      from (select *, case when tc = 0 then null else (2 * fc * lc + tc) // (2 * tc) end as share_c,
                   sum(lc) over (partition by order_id order by order_detail_id
                                 rows between unbounded preceding and current row) as running
            from wide_base) a) b""",
    "cents_window": """
select *, case when completes then fc - coalesce(before_c, 0) else share_c end as value_c
from (select *, running = tc and lc <> 0 and share_c is not null as completes,
             sum(share_c) over (partition by order_id order by order_detail_id
                                rows between unbounded preceding and 1 preceding) as before_c
      from (select *, case when tc = 0 then null else (2 * fc * lc + tc) // (2 * tc) end as share_c,
                   sum(lc) over (partition by order_id order by order_detail_id
                                 rows between unbounded preceding and current row) as running
            from window_pairs) a) b""",
}

_ALL = {**FIXTURE_CTES, **HELPER_CTES}
_ORDER = list(_ALL)


def _with(sql: str) -> str:
    """Prefix ``sql`` with the CTEs it needs (transitively), in dependency order."""
    import re

    need: set[str] = set()
    stack = [sql]
    while stack:
        text = stack.pop()
        for name in _ORDER:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                stack.append(_ALL[name])
    ctes = [f"{n} as ({_ALL[n].strip()})" for n in _ORDER if n in need]
    return ("with " + ",\n".join(ctes) + "\n" + sql) if ctes else sql




def _age(a: str) -> str:
    return (f"case when {a} is null then null when {a} > 0 and {a} <= 6 then '婴幼儿' when {a} <= 12 then '少儿' "
            f"when {a} <= 17 then '青少年' when {a} <= 45 then '青年' when {a} <= 69 then '中年' else '老年' end")


_DIM_TOPICS = {"province": "BASE_PROVINCE", "user": "USER_INFO", "sku": "SKU_INFO", "spu": "SPU_INFO",
               "trademark": "BASE_TRADEMARK", "category3": "BASE_CATEGORY3"}
_DIM_VIEWS = {"province": "province_info", "user": "user_info", "sku": "sku_info", "spu": "spu_info",
              "trademark": "trademark_info", "category3": "category3_info"}

_DAU_COLS = "mid, uid, ar, ch, vc, dt, hr, mi, ts"

_RAW = {
    "route_app_logs": """
select case when has_start then 'GMALL_START' else 'GMALL_EVENT' end as topic, event_id from app_log""",
    "cdc_batch_flatten": """
select 'ODS_T_ORDER_INFO' as topic, id from order_info where (id // 4) % 10 >= 2
union all
select 'ODS_T_ORDER_DETAIL' as topic, id from order_detail where (order_id // 4) % 10 >= 2""",
    "cdc_row_route": " union all ".join(
        f"select 'ODS_T_{t}' as topic, {'tm_id' if d == 'trademark' else 'id'} as key from {_DIM_VIEWS[d]}"
        for d, t in _DIM_TOPICS.items()),
    "decode_order_info": """
select id, province_id, order_status, user_id, final_total_amount, cast(0 as double) as benefit_reduce_amount,
       original_total_amount, cast(0 as double) as feight_fee, cast(null as varchar) as expire_time, create_time,
       cast(null as varchar) as operate_time
from order_info where id % 97 <> 0 and id % 89 <> 0""",
    "decode_quarantine": "select id from order_info where id % 97 = 0 or id % 89 = 0",
    "start_log_rejects": "select event_id from app_log where has_start and event_id % 103 = 0",
    "offset_ledger": """
select case when has_start then 'GMALL_START' else 'GMALL_EVENT' end as topic,
       cast(cast(uid as bigint) % 4 as bigint) as partition, max(event_id) + 1 as next_offset
from app_log group by 1, 2""",
    "start_log_project": "select event_id, mid, uid, ar, ch, vc, dt, hr, mi, ts from start_log",
    "order_date_parts": """
select id, substr(create_time, 1, 10) as create_date, substr(create_time, 12, 2) as create_hour from order_info""",
    "order_province": """
select o.id, o.province_id, p.name as province_name, p.area_code as province_area_code,
       p.iso_3166_2 as province_3166_2_code
from order_info o left join province_info p on cast(o.province_id as varchar) = p.id""",
    "order_user_profile": f"""
select id, user_id, {_age('a')} as user_age_group,
       case gender when 'F' then '女' when 'M' then '男' end as user_gender
from (select o.id, o.user_id, u.gender, 2024 - cast(substr(u.birthday, 1, 4) as integer) as a
      from order_info o left join user_info u on cast(o.user_id as varchar) = u.id) x""",
    "order_users_needed": """
select id, name from user_info u where exists (select 1 from order_info o where cast(o.user_id as varchar) = u.id)""",
    "detail_dims": """
select d.id, d.order_id, d.sku_id, cast(s.spu_id as bigint) as spu_id, cast(s.tm_id as bigint) as tm_id,
       cast(s.category3_id as bigint) as category3_id, sp.spu_name, tm.tm_name, c3.name as category3_name
from order_detail d
left join sku_info s on cast(d.sku_id as varchar) = s.id
left join spu_info sp on s.spu_id = sp.id
left join trademark_info tm on s.tm_id = tm.tm_id
left join category3_info c3 on s.category3_id = c3.id""",
    "detail_dims_rejects": """
select d.id, d.order_id, d.sku_id from order_detail d
where not exists (select 1 from sku_info s where s.id = cast(d.sku_id as varchar) and cast(s.id as bigint) % 13 <> 0)""",
    "wide_window_join": "select order_id, order_detail_id from window_pairs",
    "wide_retained_join": """
select i.id as order_id, d.id as order_detail_id from order_info i join order_detail d
  on i.id = d.order_id and abs(i.arrive_s - d.arrive_s) <= 10""",
    "wide_retained_outer": """
select case when d.id is null then 'info' when i.id is null then 'detail' else 'pair' end as side,
       coalesce(i.id, d.order_id) as order_id, d.id as order_detail_id
from order_info i full join order_detail d on i.id = d.order_id and abs(i.arrive_s - d.arrive_s) <= 10""",
    "wide_full_outer": """
select coalesce(i.id, d.order_id) as order_id, d.id as order_detail_id, i.final_total_amount
from order_info i full join order_detail d on i.id = d.order_id""",
    "order_wide": f"""
select d.id as order_detail_id, i.id as order_id, i.order_status, i.create_time, i.user_id, d.sku_id,
       d.order_price as sku_price, d.sku_num, d.sku_name, cast(0 as double) as benefit_reduce_amount,
       i.original_total_amount, cast(0 as double) as feight_fee, i.final_total_amount,
       case when w.tc = 0 then null else cast((2 * w.fc * w.lc * 100 + w.tc) // (2 * w.tc) as double) / 10000
       end as final_detail_amount,
       cast(null as varchar) as if_first_order, p.name as province_name, p.area_code as province_area_code,
       {_age('u.age')} as user_age_group,
       case u.gender when 'F' then '女' when 'M' then '男' end as user_gender,
       substr(i.create_time, 1, 10) as dt,
       cast(s.spu_id as bigint) as spu_id, cast(s.tm_id as bigint) as tm_id,
       cast(s.category3_id as bigint) as category3_id, sp.spu_name, tm.tm_name, c3.name as category3_name
from order_info i join order_detail d on i.id = d.order_id
join wide_base w on w.order_id = i.id and w.order_detail_id = d.id
left join province_info p on cast(i.province_id as varchar) = p.id
left join (select *, 2024 - cast(substr(birthday, 1, 4) as integer) as age from user_info) u
  on cast(i.user_id as varchar) = u.id
left join sku_info s on cast(d.sku_id as varchar) = s.id
left join spu_info sp on s.spu_id = sp.id
left join trademark_info tm on s.tm_id = tm.tm_id
left join category3_info c3 on s.category3_id = c3.id""",
    "order_wide_dedup": """
select order_id, order_detail_id, sku_id, sku_price, sku_num from (
  select r.order_id, r.id as order_detail_id, r.sku_id, r.order_price as sku_price, r.sku_num,
         row_number() over (partition by r.order_id, r.id order by r.sku_id, r.tie_break, r.order_price, r.sku_num) rn
  from order_detail_raw r join order_info i on i.id = r.order_id) x where rn = 1""",
    "apportion_exact": """
select order_id, order_detail_id,
       case when tc = 0 then null else cast((2 * fc * lc * 100 + tc) // (2 * tc) as double) / 10000 end
       as final_detail_amount
from wide_base""",
    "apportion_cents": """
select order_id, order_detail_id, cast(value_c as double) / 100 as final_detail_amount from cents_window""",
    "dau_dedup": f"select {_DAU_COLS} from dau",
    "dau_total": "select '2024-01-07' as dt, count(*) as dau from dau where day = '20240107'",
    "dau_hour": "select hr, count(*) as n from dau where day = '20240107' group by hr",
    "order_amount_total": """
select coalesce(cast(sum(cast(final_total_amount as decimal(12,2))) as double), 0) as amount_order_total,
       coalesce(cast(sum(value_c) as double) / 100, 0) as amount_line_share
from cents_wide where dt = '1996-09-17'""",
    "order_amount_hour": """
select cast(hour(strptime(create_time, '%Y-%m-%d %H:%M:%S')) as bigint) as hr,
       cast(sum(cast(final_total_amount as decimal(12,2))) as double) as amount
from cents_wide where dt = '1996-09-17' group by 1""",
    "order_amount_day_hour": """
select dt, cast(hour(strptime(create_time, '%Y-%m-%d %H:%M:%S')) as bigint) as hr,
       cast(sum(cast(final_total_amount as decimal(12,2))) as double) as amount
from cents_wide group by 1, 2""",
    "hourly_compare_dau": """
select case when day = '20240107' then 'today' else 'yesterday' end as day, hr, count(*) as value
from dau where day in ('20240107', '20240106') group by 1, 2""",
    "hourly_compare_amount": """
select case when dt = '1996-09-17' then 'today' else 'yesterday' end as day,
       cast(hour(strptime(create_time, '%Y-%m-%d %H:%M:%S')) as varchar) as hr,
       cast(sum(cast(final_total_amount as decimal(12,2))) as double) as value
from cents_wide where dt in ('1996-09-17', '1996-09-16') group by 1, 2""",
    "kpi_list": """
select 'dau' as id, '新增日活' as name, cast(count(*) as varchar) as value from dau where day = '20240107'
union all select 'new_mid', '新增设备', cast(null as varchar)
union all select 'new_order', '订单金额',
       cast(coalesce(sum(cast(final_total_amount as decimal(12,2))), 0) as varchar)
from cents_wide where dt = '1996-09-17'""",
    "range_text_search": r"""
select p_partkey, p_name, cast(p_size as bigint) as p_size from part
where p_size between 6 and 10 and list_contains(regexp_split_to_array(lower(p_name), '[^\p{L}\p{N}_]+'), 'red')""",
    "sink_archive": "select strftime(ts, '%Y-%m-%d') as dt, mid, epoch_us(ts) // 1000 as ts from app_log",
    "sink_upsert": f"select {_DAU_COLS} from dau",
    "sink_append": "select event_id, ch from app_log",
    "sink_topic": """
select case when has_start then 'GMALL_START' else 'GMALL_EVENT' end as topic, event_id, mid from app_log""",
    "wide_row_text": """
select d.id as order_detail_id,
       concat('order_id:', cast(i.id as varchar), '|order_detail_id:', cast(d.id as varchar),
              '|sku_price:', cast(cast(d.order_price as decimal(18,2)) as varchar),
              '|sku_num:', cast(d.sku_num as varchar),
              '|original_total_amount:', cast(cast(i.original_total_amount as decimal(18,2)) as varchar),
              '|final_total_amount:', cast(cast(i.final_total_amount as decimal(18,2)) as varchar),
              '|final_detail_amount:0.00') as text
from order_info i join order_detail d on i.id = d.order_id""",
}
_RAW["order_user_profile_bucketed"] = _RAW["order_user_profile"]
_RAW["sink_order_wide"] = _RAW["order_wide"].replace(
    """case when w.tc = 0 then null else cast((2 * w.fc * w.lc * 100 + w.tc) // (2 * w.tc) as double) / 10000
       end as final_detail_amount""", "cast(w.value_c as double) / 100 as final_detail_amount"
).replace("join wide_base w", "join cents_wide w")

# Oracles of streaming twins that have no batch query of the same shape.
_TWINS = {
    "order_wide_sums": """
select substr(i.create_time, 1, 10) as dt, w.order_id, count(*) as n_lines, cast(sum(w.value_c) as double) / 100 as amount
from cents_window w join order_info i on i.id = w.order_id group by 1, 2""",
    "detail_dims_inserted": _RAW["detail_dims"] + "\nwhere (d.order_id // 4) % 10 >= 2",
}
_TWINS["order_wide_chain"] = _RAW["order_wide"].replace(
    """case when w.tc = 0 then null else cast((2 * w.fc * w.lc * 100 + w.tc) // (2 * w.tc) as double) / 10000
       end as final_detail_amount""", "cast(sum(w.value_c) over (partition by i.id) as double) / 100 as order_share"
).replace("join wide_base w", "join cents_window w")
# Deliveries of a feed: rows in five batches by arrival, every eleventh one batch later; late is what lies 600 s or
# more behind the greatest arrival of the batches before.
_TWINS["late_rows"] = """
select 'info' as side, id from info_gated where late union all select 'detail', id from detail_gated where late"""
_TWINS["retained_outer"] = """
select case when d.id is null then 'info' when i.id is null then 'detail' else 'pair' end as side,
       coalesce(i.id, d.order_id) as order_id, d.id as order_detail_id
from (select * from info_gated where not late) i full join (select * from detail_gated where not late) d
  on i.id = d.order_id and abs(i.arrive_s - d.arrive_s) <= 600"""
_TWINS["source_ledger"] = """
select 'APP_LOG' as topic, cast(cast(uid as bigint) % 4 as bigint) as partition, max(event_id) + 1 as next_offset,
       count(*) as n_records
from app_log group by 1, 2"""
for _d in _DIM_VIEWS:
    _RAW[f"dim_upsert_{_d}"] = f"select * from {_DIM_VIEWS[_d]}"


def oracle() -> dict[str, str]:
    return {k: _with(v) for k, v in _RAW.items()}


def twin_only() -> dict[str, str]:
    return {k: _with(v) for k, v in _TWINS.items()}
