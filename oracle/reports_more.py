"""DuckDB SQL for the remaining star reports."""

from __future__ import annotations

from oracle.reports import DAYS, avg2, case, half_up, lag_counts, span, weekday_sums  # noqa: F401

_D = [d[:3].lower() for d in DAYS]

# ---- conditional sums ------------------------------------------------------

case("q2", dict(year=1998), f"""
  with weekly as (
    select d_week_seq, {weekday_sums('ext_sales_price')}
    from all_sales join date_dim on d_date_sk = sold_date_sk
    where channel in ('web', 'catalog') group by d_week_seq),
  a as (select weekly.* from weekly join date_dim using (d_week_seq) where d_year = 1998),
  b as (select weekly.* from weekly join date_dim using (d_week_seq) where d_year = 1999)
  select a.d_week_seq as d_week_seq1, {', '.join(half_up(f'a.{d}_sales / b.{d}_sales') + f' as {d}_ratio' for d in _D)}
  from a join b on b.d_week_seq = a.d_week_seq + 53""", "d_week_seq1", None)

case("q59", dict(month=1204), f"""
  with weekly as (
    select d_week_seq, ss_store_sk, {weekday_sums('ss_sales_price')}
    from store_sales join date_dim on d_date_sk = ss_sold_date_sk group by all),
  named as (select weekly.*, s_store_name, s_store_id from weekly join store on s_store_sk = ss_store_sk),
  a as (select named.* from named join date_dim using (d_week_seq) where d_month_seq between 1204 and 1215),
  b as (select named.* from named join date_dim using (d_week_seq) where d_month_seq between 1216 and 1227)
  select a.s_store_name as s_store_name1, a.s_store_id as s_store_id1, a.d_week_seq as d_week_seq1,
    {', '.join(f'a.{d}_sales / b.{d}_sales as {d}_ratio' for d in _D)}
  from a join b on b.s_store_id = a.s_store_id and b.d_week_seq = a.d_week_seq + 52""",
     "s_store_name1 s_store_id1 d_week_seq1")

case("q9", dict(thresholds=(3000, 900000, 3000, 900000, 3000), width=10), "select " + ", ".join(
    f"(select case when count(*) > {n} then {avg2('ss_ext_tax')} else {avg2('ss_net_paid')} end "
    f"from store_sales where ss_quantity between {i * 10 + 1} and {i * 10 + 10}) as bucket{i + 1}"
    for i, n in enumerate((3000, 900000, 3000, 900000, 3000))) + " from reason where r_reason_sk = 1")

_BANDS28 = ((0, 5, 1000, 460, 140), (6, 10, 910, 1430, 320), (11, 15, 660, 920, 400), (16, 20, 1420, 3054, 800),
            (21, 25, 1350, 1418, 380), (26, 30, 280, 2513, 420))
case("q28", dict(bands=_BANDS28, widths=(1000, 1000, 2000)), "select * from " + ", ".join(
    f"(select {avg2('ss_list_price')} as b{i}_lp, count(ss_list_price) as b{i}_cnt, "
    f"count(distinct ss_list_price) as b{i}_cntd from store_sales where ss_quantity between {lo} and {hi} and "
    f"(ss_list_price between {p} and {p + 1000} or ss_coupon_amt between {c} and {c + 1000} "
    f"or ss_wholesale_cost between {w} and {w + 2000})) t{i}"
    for i, (lo, hi, p, c, w) in enumerate(_BANDS28, 1)))

case("q21", dict(pivot="1998-04-08", price=(30, 150)), """
  with x as (
    select w_warehouse_name, i_item_id,
      cast(sum(case when d_date < date '1998-04-08' then inv_quantity_on_hand else 0 end) as bigint) as inv_before,
      cast(sum(case when d_date >= date '1998-04-08' then inv_quantity_on_hand else 0 end) as bigint) as inv_after
    from inventory join date_dim on d_date_sk = inv_date_sk
        and d_date between date '1998-04-08' - 30 and date '1998-04-08' + 30
      join item on i_item_sk = inv_item_sk and i_current_price between 30 and 150
      join warehouse on w_warehouse_sk = inv_warehouse_sk group by all)
  select * from x where inv_before > 0 and inv_after / inv_before between 2e0 / 3e0 and 3e0 / 2e0""",
     "w_warehouse_name i_item_id")

case("q40", dict(pivot="1998-04-08", price=(30, 150)), """
  select w_state, i_item_id,
    round(sum(case when d_date < date '1998-04-08' then net else 0 end), 2) as sales_before,
    round(sum(case when d_date >= date '1998-04-08' then net else 0 end), 2) as sales_after
  from (select *, cs_sales_price - coalesce(cr_refunded_cash, 0) as net from catalog_sales
        left join catalog_returns on cr_order_number = cs_order_number and cr_item_sk = cs_item_sk) s
    join warehouse on w_warehouse_sk = cs_warehouse_sk
    join item on i_item_sk = cs_item_sk and i_current_price between 30 and 150
    join date_dim on d_date_sk = cs_sold_date_sk and d_date between date '1998-04-08' - 30 and date '1998-04-08' + 30
  group by all""", "w_state i_item_id")

_COUNTIES = tuple(f"NATION_{n} county {c}" for n in range(0, 25, 2) for c in range(4))


def _tickets(dates: str, ratio: float) -> str:
    return f"""(select ss_ticket_number, ss_customer_sk, count(*) as cnt
    from store_sales join date_dim on d_date_sk = ss_sold_date_sk and {dates}
      join store on s_store_sk = ss_store_sk and s_county in {_COUNTIES}
      join household_demographics on hd_demo_sk = ss_hdemo_sk and hd_buy_potential in ('>10000', '5001-10000')
        and hd_vehicle_count > 0
    where hd_dep_count / hd_vehicle_count > {ratio}
    group by all) tickets join customers on c_customer_sk = ss_customer_sk"""


_TICKET_COLS = "c_last_name, c_first_name, c_salutation, c_preferred_cust_flag, ss_ticket_number, cnt"
case("q34", dict(year=1998, counties=_COUNTIES, sizes=(2, 20)), f"""
  select {_TICKET_COLS} from {_tickets("(d_dom <= 3 or d_dom between 25 and 28) and d_year in (1998, 1999, 2000)", 1.2)}
  where cnt between 2 and 20""", "c_last_name c_first_name c_salutation -c_preferred_cust_flag", None)
case("q73", dict(year=1998, counties=_COUNTIES, sizes=(1, 5)), f"""
  select {_TICKET_COLS} from {_tickets("d_dom <= 2 and d_year in (1998, 1999, 2000)", 1)}
  where cnt between 1 and 5""", "-cnt c_last_name", None)

_CITIES = tuple(f"city {i}" for i in range(0, 20, 2))


def _moved(dates: str, aggs: str) -> str:
    return f"""(select ss_ticket_number, ss_customer_sk, ss_addr_sk, ca_city as bought_city, {aggs}
    from store_sales join date_dim on d_date_sk = ss_sold_date_sk and {dates} and d_year in (1998, 1999, 2000)
      join store on s_store_sk = ss_store_sk and s_city in {_CITIES}
      join household_demographics on hd_demo_sk = ss_hdemo_sk and (hd_dep_count = 6 or hd_vehicle_count = 3)
      join customer_address on ca_address_sk = ss_addr_sk
    group by all) tickets
    join customers on c_customer_sk = ss_customer_sk
    join customer_address home on home.ca_address_sk = c_current_addr_sk and home.ca_city <> bought_city"""


case("q46", dict(year=1998, cities=_CITIES), f"""
  select c_last_name, c_first_name, home.ca_city, bought_city, ss_ticket_number, amt, profit
  from {_moved("d_dow in (6, 0)", "round(sum(ss_coupon_amt), 2) as amt, round(sum(ss_net_profit), 2) as profit")}""",
     "c_last_name c_first_name ca_city bought_city ss_ticket_number")
case("q68", dict(year=1998, cities=_CITIES), f"""
  select c_last_name, c_first_name, home.ca_city, bought_city, ss_ticket_number, extended_price, extended_tax, list_price
  from {_moved("d_dom in (1, 2)", "round(sum(ss_ext_sales_price), 2) as extended_price, "
               "round(sum(ss_ext_list_price), 2) as list_price, round(sum(ss_ext_tax), 2) as extended_tax")}""",
     "c_last_name ss_ticket_number")

_M = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _months(x: str, name: str) -> str:
    return ", ".join(f"round(coalesce(sum({x}) filter (d_moy = {i}), 0), 2) as {m}_{name}" for i, m in enumerate(_M, 1))


case("q66", dict(year=1999, start=30000, carriers=("CARRIER1", "CARRIER3")), f"""
  with s as (
    select ws_sold_date_sk as dk, ws_sold_time_sk as tk, ws_ship_mode_sk as mk, ws_warehouse_sk as wk,
      ws_sales_price * ws_quantity as sales, ws_net_paid_inc_tax * ws_quantity as net from web_sales
    union all
    select cs_sold_date_sk, cs_sold_time_sk, cs_ship_mode_sk, cs_warehouse_sk,
      cs_ext_sales_price * cs_quantity, cs_net_paid_inc_ship_tax * cs_quantity from catalog_sales),
  g as (
    select w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country,
      'CARRIER1,CARRIER3' as ship_carriers, d_year as year, {_months('sales', 'sales')}, {_months('net', 'net')}
    from s join date_dim on d_date_sk = dk and d_year = 1999
      join time_dim on t_time_sk = tk and t_time between 30000 and 58800
      join ship_mode on sm_ship_mode_sk = mk and sm_carrier in ('CARRIER1', 'CARRIER3')
      join warehouse on w_warehouse_sk = wk
    group by all)
  select w_warehouse_name, w_warehouse_sq_ft, w_city, w_county, w_state, w_country, ship_carriers, year,
    {', '.join(m + '_sales' for m in _M)},
    {', '.join(f'{m}_sales / w_warehouse_sq_ft as {m}_sales_per_sq_foot' for m in _M)},
    {', '.join(m + '_net' for m in _M)} from g""", "w_warehouse_name")

for _name, _extra in (("q39", ""), ("q39b", " and a.cov > 1.5")):
    case(_name, dict(year=1998, month=4), f"""
      with s as (
        select inv_warehouse_sk as w_warehouse_sk, inv_item_sk as i_item_sk, d_moy,
          avg(inv_quantity_on_hand) as mean,
          round(stddev_samp(inv_quantity_on_hand) / nullif(avg(inv_quantity_on_hand), 0), 6) as cov
        from inventory join date_dim on d_date_sk = inv_date_sk and d_year = 1998
          join item on i_item_sk = inv_item_sk join warehouse on w_warehouse_sk = inv_warehouse_sk
        group by all having cov > 1)
      select a.*, b.w_warehouse_sk as w_warehouse_sk2, b.i_item_sk as i_item_sk2, b.d_moy as d_moy2, b.mean as mean2, b.cov as cov2
      from s a join s b on b.w_warehouse_sk = a.w_warehouse_sk and b.i_item_sk = a.i_item_sk
      where a.d_moy = 4 and b.d_moy = 5{_extra}""",
         "w_warehouse_sk i_item_sk d_moy mean cov d_moy2 mean2 cov2", None)

case("q72", dict(potential="1001-5000", marital="M", year=1999), """
  select i_item_desc, w_warehouse_name, sold.d_week_seq, count(*) filter (p_promo_sk is null) as no_promo,
    count(*) filter (p_promo_sk is not null) as promo, count(*) as total_cnt
  from catalog_sales
    join date_dim sold on sold.d_date_sk = cs_sold_date_sk and sold.d_year = 1999
    join date_dim sent on sent.d_date_sk = cs_ship_date_sk and sent.d_date > sold.d_date + 5
    join inventory on inv_item_sk = cs_item_sk and inv_quantity_on_hand < cs_quantity
    join date_dim stock on stock.d_date_sk = inv_date_sk and stock.d_week_seq = sold.d_week_seq
    join warehouse on w_warehouse_sk = inv_warehouse_sk
    join item on i_item_sk = cs_item_sk
    join customer_demographics on cd_demo_sk = cs_bill_cdemo_sk and cd_marital_status = 'M'
    join household_demographics on hd_demo_sk = cs_bill_hdemo_sk and hd_buy_potential = '1001-5000'
    left join promotion on p_promo_sk = cs_promo_sk
    left join catalog_returns on cr_item_sk = cs_item_sk and cr_order_number = cs_order_number
  group by all""", "-total_cnt i_item_desc w_warehouse_name d_week_seq")

case("q76", {}, """
  with s as (
    select 'store' as channel, 'ss_addr_sk' as col_name, ss_sold_date_sk as dk, ss_item_sk as ik, ss_ext_sales_price as p
    from store_sales where ss_addr_sk is null
    union all select 'web', 'ws_web_page_sk', ws_sold_date_sk, ws_item_sk, ws_ext_sales_price
    from web_sales where ws_web_page_sk is null
    union all select 'catalog', 'cs_warehouse_sk', cs_sold_date_sk, cs_item_sk, cs_ext_sales_price
    from catalog_sales where cs_warehouse_sk is null)
  select channel, col_name, d_year, d_qoy, i_category, count(*) as sales_cnt, round(sum(p), 2) as sales_amt
  from s join date_dim on d_date_sk = dk join item on i_item_sk = ik group by all""",
     "channel col_name d_year d_qoy i_category")

case("q93", dict(reason="reason 7"), """
  select ss_customer_sk, round(sum((ss_quantity - coalesce(sr_return_quantity, 0)) * ss_sales_price), 2) as sumsales
  from store_sales left join store_returns on sr_item_sk = ss_item_sk and sr_ticket_number = ss_ticket_number
  where sr_reason_sk in (select r_reason_sk from reason where r_reason_desc = 'reason 7')
  group by ss_customer_sk""", "sumsales ss_customer_sk")

# ---- aggregates of related rows -------------------------------------------

case("q1", dict(year=2000, state="NATION_5"), f"""
  with r as (
    select sr_customer_sk as c, sr_store_sk as s, round(sum(sr_fee), 2) as amt
    from store_returns join date_dim on d_date_sk = sr_returned_date_sk and d_year = 2000 group by all)
  select c_customer_id from r join store on s_store_sk = s and s_state = 'NATION_5' join customers on c_customer_sk = c
  where amt > (select {avg2('amt')} * 1.2e0 from r r2 where r2.s = r.s)""", "c_customer_id")

_C30 = ("c_customer_id c_salutation c_first_name c_last_name c_preferred_cust_flag c_birth_day c_birth_month c_birth_year "
        "c_birth_country c_login c_email_address c_last_review_date_sk ctr_total_return")
_C81 = ("c_customer_id c_salutation c_first_name c_last_name ca_street_number ca_street_name ca_street_type ca_suite_number "
        "ca_city ca_county ca_state ca_zip ca_country ca_gmt_offset ca_location_type ctr_total_return")
for _name, _fact, _p, _amt, _year, _cols in (("q30", "web_returns", "wr_", "return_amt", 1999, _C30),
                                             ("q81", "catalog_returns", "cr_", "return_amt_inc_tax", 1998, _C81)):
    case(_name, dict(year=_year, state="NATION_5"), f"""
      with r as (
        select {_p}returning_customer_sk as c, ca_state as st, round(sum({_p}{_amt}), 2) as ctr_total_return
        from {_fact} join date_dim on d_date_sk = {_p}returned_date_sk and d_year = {_year}
          join customer_address on ca_address_sk = {_p}returning_addr_sk group by all)
      select {_cols.replace(' ', ', ')}
      from r join customers on c_customer_sk = c
        join customer_address on ca_address_sk = c_current_addr_sk and ca_state = 'NATION_5'
      where ctr_total_return > (select {avg2('ctr_total_return')} * 1.2e0 from r r2 where r2.st = r.st)""", _cols)

case("q6", dict(year=2000, month=2, factor=1.2, least=2), f"""
  select ca_state as state, count(*) as cnt
  from store_sales join date_dim on d_date_sk = ss_sold_date_sk
    join customers on c_customer_sk = ss_customer_sk
    join customer_address on ca_address_sk = c_current_addr_sk
    join item i on i.i_item_sk = ss_item_sk
  where d_month_seq = (select distinct d_month_seq from date_dim where d_year = 2000 and d_moy = 2)
    and i.i_current_price > 1.2e0 * (select {avg2('j.i_current_price')} from item j where j.i_category = i.i_category)
  group by ca_state having count(*) >= 2""", "cnt")

for _name, _fact, _p, _maker in (("q32", "catalog_sales", "cs_", 21), ("q92", "web_sales", "ws_", 73)):
    case(_name, dict(maker=_maker, start="1998-03-18"), f"""
      with s as (
        select {_p}item_sk as k, {_p}ext_discount_amt as amt from {_fact}
          join date_dim on d_date_sk = {_p}sold_date_sk and {span('1998-03-18', 90)}
          join item on i_item_sk = {_p}item_sk and i_manufact_id = {_maker})
      select round(sum(amt), 2) as excess_discount_amount
      from s where amt > (select 1.3e0 * ({avg2('z.amt')}) from s z where z.k = s.k)""")


def _active(dates: str) -> tuple[str, str, str]:
    def one(fact, who, sold):
        return (f"exists (from {fact} join date_dim on d_date_sk = {sold} where {who} = c_customer_sk and {dates})")
    return (one("store_sales", "ss_customer_sk", "ss_sold_date_sk"),
            one("web_sales", "ws_bill_customer_sk", "ws_sold_date_sk"),
            one("catalog_sales", "cs_ship_customer_sk", "cs_sold_date_sk"))


_WHO = """from customers join customer_address on ca_address_sk = c_current_addr_sk
    join customer_demographics on cd_demo_sk = c_current_cdemo_sk"""
_KEYS10 = ("cd_gender cd_marital_status cd_education_status cd_purchase_estimate cd_credit_rating cd_dep_count "
           "cd_dep_employed_count cd_dep_college_count")
_s, _w, _c = _active("d_year = 1999 and d_moy between 4 and 7")
case("q10", dict(counties=_COUNTIES[:24], year=1999, month=4), f"""
  select {_KEYS10.replace(' ', ', ')}, {', '.join(f'count(*) as cnt{i}' for i in range(1, 7))}
  {_WHO} where ca_county in {_COUNTIES[:24]} and {_s} and ({_w} or {_c}) group by {_KEYS10.replace(' ', ', ')}""", _KEYS10)
_K35 = "ca_state cd_gender cd_marital_status cd_dep_count cd_dep_employed_count cd_dep_college_count"
_s, _w, _c = _active("d_year = 1999 and d_qoy < 4")
case("q35", dict(year=1999), f"""
  select {_K35.replace(' ', ', ')}, {', '.join(
      f'count(*) as cnt{i}, avg({c}) as avg{i}, max({c}) as max{i}, cast(sum({c}) as bigint) as sum{i}'
      for i, c in enumerate(_K35.split()[3:], 1))}
  {_WHO} where {_s} and ({_w} or {_c}) group by {_K35.replace(' ', ', ')}""", _K35)
_K69 = " ".join(_KEYS10.split()[:5])
_s, _w, _c = _active("d_year = 1999 and d_moy between 1 and 3")
case("q69", dict(states=("NATION_1", "NATION_5", "NATION_9"), year=1999, month=1), f"""
  select {_K69.replace(' ', ', ')}, {', '.join(f'count(*) as cnt{i}' for i in range(1, 4))}
  {_WHO} where ca_state in ('NATION_1', 'NATION_5', 'NATION_9') and {_s} and not {_w} and not {_c}
  group by {_K69.replace(' ', ', ')}""", _K69)

_CC = tuple(f"NATION_{n} county {c}" for n in range(25) for c in (0, 1))
case("q16", dict(start="1999-4-01", state="NATION_5", counties=_CC), f"""
  select count(distinct cs_order_number) as order_count, round(sum(cs_ext_ship_cost), 2) as total_shipping_cost,
    round(sum(cs_net_profit), 2) as total_net_profit
  from catalog_sales a join date_dim on d_date_sk = cs_ship_date_sk and {span('1999-04-01', 60)}
    join customer_address on ca_address_sk = cs_ship_addr_sk and ca_state = 'NATION_5'
    join call_center on cc_call_center_sk = cs_call_center_sk and cc_county in {_CC}
  where exists (from catalog_sales b where b.cs_order_number = a.cs_order_number and b.cs_warehouse_sk <> a.cs_warehouse_sk)
    and not exists (from catalog_returns where cr_order_number = a.cs_order_number)""")


def _company(extra: str) -> str:
    return f"""
  select count(distinct ws_order_number) as order_count, round(sum(ws_ext_ship_cost), 2) as total_shipping_cost,
    round(sum(ws_net_profit), 2) as total_net_profit
  from web_sales a join date_dim on d_date_sk = ws_ship_date_sk and {span('1999-05-01', 60)}
    join customer_address on ca_address_sk = ws_ship_addr_sk and ca_state = 'NATION_5'
    join web_site on web_site_sk = ws_web_site_sk and web_company_name = 'acme'
  where {extra}"""


case("q94", dict(start="1999-5-01", state="NATION_5", company="acme"), _company(
    "exists (from web_sales b where b.ws_order_number = a.ws_order_number and b.ws_warehouse_sk <> a.ws_warehouse_sk) "
    "and not exists (from web_returns where wr_order_number = a.ws_order_number)"))
case("q95", dict(start="1999-5-01", state="NATION_5", company="acme"), _company(
    "ws_order_number in (select ws_order_number from web_sales group by 1 having count(distinct ws_warehouse_sk) > 1) "
    "and ws_order_number in (select wr_order_number from web_returns)"))

_VARIANTS = (("PROMO", ("blue", "red"), ("Each", "Box"), ("small", "medium")),
             ("LARGE", ("old", "new"), ("Pound", "Gross"), ("petite", "large")),
             ("SMALL", ("hot", "cold"), ("Bunch", "Box"), ("extra large", "medium")))
case("q41", dict(maker=42, variants=_VARIANTS), f"""
  select distinct i_product_name from item a where i_manufact_id between 42 and 82
    and (select count(*) from item b where b.i_manufact = a.i_manufact and ({' or '.join(
        f"(b.i_category = '{c}' and b.i_color in {k} and b.i_units in {u} and b.i_size in {z})"
        for c, k, u, z in _VARIANTS)})) > 0""", "i_product_name")

_REV = ("ss_item_rev", "cs_item_rev", "ws_item_rev")
case("q58", dict(day="1996-07-18"), f"""
  with r as (
    select i_item_id as item_id, {', '.join(
        f"round(sum(ext_sales_price) filter (channel = '{c}'), 2) as {n}"
        for c, n in zip(('store', 'catalog', 'web'), _REV))}
    from all_sales join item on i_item_sk = item_sk join date_dim on d_date_sk = sold_date_sk
    where d_week_seq = (select d_week_seq from date_dim where d_date = date '1996-07-18') group by i_item_id),
  a as (select *, (ss_item_rev + cs_item_rev + ws_item_rev) / 3 as average from r)
  select item_id, {', '.join(f'{n}, {n} / average * 100 as {n[:3]}dev' for n in _REV)}, average from a
  where {' and '.join(f'{x} between 0.9e0 * {y} and 1.1e0 * {y}' for x in _REV for y in _REV if x != y)}""",
     "item_id ss_item_rev")

_Q83 = ("sr", "cr", "wr")
case("q83", dict(dates=("1998-01-02", "1998-10-15", "1998-11-10", "1999-03-03", "1999-09-09")), f"""
  with d as (
    select d_date_sk from date_dim where d_week_seq in (select d_week_seq from date_dim where d_date in (
      date '1998-01-02', date '1998-10-15', date '1998-11-10', date '1999-03-03', date '1999-09-09'))),
  {', '.join(f'''{p} as (select i_item_id as item_id, cast(sum({p}_return_quantity) as bigint) as {p}_item_qty
    from {f}_returns join item on i_item_sk = {p}_item_sk join d on d_date_sk = {p}_returned_date_sk group by 1)'''
    for p, f in zip(_Q83, ('store', 'catalog', 'web')))}
  select item_id, {', '.join(f'{p}_item_qty, {p}_item_qty / (sr_item_qty + cr_item_qty + wr_item_qty) / 3e0 * 100 as {p}_dev'
                             for p in _Q83)}, (sr_item_qty + cr_item_qty + wr_item_qty) / 3e0 as average
  from sr join cr using (item_id) join wr using (item_id)""", "item_id sr_item_qty")

case("q65", dict(month=1176), f"""
  with r as (
    select ss_store_sk, ss_item_sk, round(sum(ss_sales_price), 2) as revenue
    from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_month_seq between 1176 and 1187 group by all),
  m as (select ss_store_sk, {avg2('revenue')} as ave from r group by 1)
  select s_store_name, i_item_desc, revenue, i_current_price, i_wholesale_cost, i_brand
  from r join m using (ss_store_sk) join store on s_store_sk = ss_store_sk join item on i_item_sk = ss_item_sk
  where revenue <= ave * 0.1e0""", "s_store_name i_item_desc")

# ---- windows ---------------------------------------------------------------

for _name, _ch, _limit in (("q12", "web", 100), ("q20", "catalog", 100), ("q98", "store", None)):
    case(_name, dict(categories=("PROMO", "SMALL", "LARGE"), start="2001-01-12"), f"""
      select i_item_id, i_item_desc, i_category, i_class, i_current_price, round(sum(ext_sales_price), 2) as itemrevenue,
        round(sum(ext_sales_price), 2) * 100
          / round(sum(round(sum(ext_sales_price), 2)) over (partition by i_class), 2) as revenueratio
      from all_sales join item on i_item_sk = item_sk and i_category in ('PROMO', 'SMALL', 'LARGE')
        join date_dim on d_date_sk = sold_date_sk and {span('2001-01-12', 30)}
      where channel = '{_ch}'
      group by i_item_id, i_item_desc, i_category, i_class, i_current_price""",
         "i_category i_class i_item_id i_item_desc revenueratio", _limit)

case("q44", dict(store=7, k=10), f"""
  with m as (
    select ss_item_sk, {avg2('ss_net_profit')} as v from store_sales where ss_store_sk = 7 group by 1
    having v > 0.9e0 * (select {avg2('ss_net_profit')} from store_sales where ss_store_sk = 7 and ss_hdemo_sk is null)),
  r as (select ss_item_sk, rank() over (order by v) as up, rank() over (order by v desc) as down from m)
  select a.up as rnk, x.i_product_name as best_performing, y.i_product_name as worst_performing
  from r a join r b on b.down = a.up and a.up <= 10
    join item x on x.i_item_sk = a.ss_item_sk join item y on y.i_item_sk = b.ss_item_sk""", "rnk")

case("q49", dict(year=2000, month=12, least=1000, k=10), """
  with m as (
    select s.channel, s.item_sk as item, cast(sum(coalesce(return_quantity, 0)) as double) / cast(sum(quantity) as double) as return_ratio,
      round(sum(coalesce(return_amt, 0)), 2) / round(sum(net_paid), 2) as currency_ratio
    from all_sales s left join all_returns r using (channel, order_no, item_sk)
      join date_dim on d_date_sk = sold_date_sk and d_year = 2000 and d_moy = 12
    where return_amt > 1000 and net_profit > 1 and net_paid > 0 and quantity > 0
    group by s.channel, s.item_sk),
  k as (select *, rank() over (partition by channel order by return_ratio) as return_rank,
          rank() over (partition by channel order by currency_ratio) as currency_rank from m)
  select distinct channel, item, return_ratio, return_rank, currency_rank from k
  where return_rank <= 10 or currency_rank <= 10""", "channel return_rank currency_rank")


def _monthly(fact: str, p: str, join: str, group: str, kept: str) -> str:
    on = " and ".join(f"a.{g} = {{n}}.{g}" for g in group.split(", "))
    return f"""
  with v as (
    select *, rank() over (partition by {group} order by d_year, d_moy) as rn from (
    select {group}, d_year, d_moy, round(sum({p}sales_price), 2) as sum_sales
    from {fact} join item on i_item_sk = {p}item_sk join date_dim on d_date_sk = {p}sold_date_sk join {join}
    where d_year * 12 + d_moy between 1998 * 12 and 1999 * 12 + 1 group by all)),
  w as (select *, round(sum(sum_sales) over (partition by {group}, d_year), 2)
          / count(*) over (partition by {group}, d_year) as avg_monthly_sales from v)
  select {kept}, a.d_year, a.d_moy, a.avg_monthly_sales, a.sum_sales, l.sum_sales as psum, n.sum_sales as nsum
  from w a join w l on {on.format(n='l')} and l.rn = a.rn - 1 join w n on {on.format(n='n')} and n.rn = a.rn + 1
  where a.d_year = 1998 and a.avg_monthly_sales > 0
    and abs(a.sum_sales - a.avg_monthly_sales) / a.avg_monthly_sales > 0.1"""


_GAP = ["sum_sales - avg_monthly_sales asc nulls first", '"d_moy" asc nulls first']
case("q47", dict(year=1998), _monthly("store_sales", "ss_", "store on s_store_sk = ss_store_sk",
                                      "i_category, i_brand, s_store_name, s_company_name", "a.i_category"), _GAP)
case("q57", dict(year=1998), _monthly("catalog_sales", "cs_", "call_center on cc_call_center_sk = cs_call_center_sk",
                                      "i_category, i_brand, cc_name", "a.i_category, a.i_brand"), _GAP)

_LINES = ((("PROMO", "SMALL"), ("PROMO-1", "PROMO-2", "SMALL-0", "SMALL-4"), tuple(f"Brand#{i}" for i in range(1, 13))),
          (("LARGE", "MEDIUM"), ("LARGE-1", "MEDIUM-3"), tuple(f"Brand#{i}" for i in range(10, 26))))
_LINE_SQL = " or ".join(f"(i_category in {c} and i_class in {k} and i_brand in {b})" for c, k, b in _LINES)
for _name, _key, _per, _mean, _order in (
        ("q53", "i_manufact_id", "d_qoy", "avg_quarterly_sales", "avg_quarterly_sales sum_sales i_manufact_id"),
        ("q63", "i_manager_id", "d_moy", "avg_monthly_sales", "i_manager_id avg_monthly_sales sum_sales")):
    case(_name, dict(month=1176, lines=_LINES), f"""
      select {_key}, sum_sales, {_mean} from (
        select *, round(sum(sum_sales) over (partition by {_key}), 2) / count(*) over (partition by {_key}) as {_mean}
        from (select {_key}, {_per}, round(sum(ss_sales_price), 2) as sum_sales
              from store_sales join item on i_item_sk = ss_item_sk and ({_LINE_SQL})
                join date_dim on d_date_sk = ss_sold_date_sk and d_month_seq between 1176 and 1187
                join store on s_store_sk = ss_store_sk group by all))
      where {_mean} > 0 and abs(sum_sales - {_mean}) / {_mean} > 0.1""", _order)

_LINES89 = tuple(l[:2] for l in _LINES)
_LINE89_SQL = " or ".join(f"(i_category in {c} and i_class in {k})" for c, k in _LINES89)
case("q89", dict(year=2000, lines=_LINES89), f"""
  select i_category, i_class, i_brand, s_store_name, s_company_name, d_moy, sum_sales, avg_monthly_sales from (
    select *, round(sum(sum_sales) over w, 2) / count(*) over w as avg_monthly_sales
    from (select i_category, i_class, i_brand, s_store_name, s_company_name, d_moy, round(sum(ss_sales_price), 2) as sum_sales
          from store_sales join item on i_item_sk = ss_item_sk and ({_LINE89_SQL})
            join date_dim on d_date_sk = ss_sold_date_sk and d_year = 2000
            join store on s_store_sk = ss_store_sk group by all)
    window w as (partition by i_category, i_brand, s_store_name, s_company_name))
  where avg_monthly_sales <> 0 and abs(sum_sales - avg_monthly_sales) / avg_monthly_sales > 0.1""",
     ["sum_sales - avg_monthly_sales asc nulls first", '"s_store_name" asc nulls first'])

case("q51", dict(month=1176), """
  with daily as (
    select channel, item_sk, d_date, round(sum(sales_price), 2) as v
    from all_sales join date_dim on d_date_sk = sold_date_sk and d_month_seq between 1176 and 1187
    where channel in ('web', 'store') and item_sk is not null group by all),
  run as (select *, round(sum(v) over (partition by channel, item_sk order by d_date rows unbounded preceding), 2) as c from daily),
  days as (select item_sk, d_date, max(c) filter (channel = 'web') as web_sales,
             max(c) filter (channel = 'store') as store_sales from run group by all)
  select *, max(web_sales) over w as web_cumulative, max(store_sales) over w as store_cumulative from days
  window w as (partition by item_sk order by d_date rows unbounded preceding)
  qualify web_cumulative > store_cumulative""", "item_sk d_date")
