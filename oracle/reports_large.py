"""DuckDB SQL for the rollup and cross-channel star reports."""

from __future__ import annotations

from oracle.reports import avg2, case, half_up, span

_TOTALS = """select channel, id, round(sum(sales), 2) as sales, round(sum(returns), 2) as returns,
    round(sum(profit), 2) as profit"""
_OUTLETS = """outlets as (
    select 'store' as ch, s_store_sk as k, 'store channel' as channel, 'store' || s_store_id as id from store
    union all select 'catalog', cp_catalog_page_sk, 'catalog channel', 'catalog_page' || cp_catalog_page_id from catalog_page
    union all select 'web', web_site_sk, 'web channel', 'web_site' || web_site_id from web_site)"""

case("q5", dict(start="1998-08-04", length=14), f"""
  with {_OUTLETS}, l as (
    select 'store' as ch, ss_store_sk as k, ss_sold_date_sk as dk, ss_ext_sales_price as sales, 0e0 as returns, ss_net_profit as profit from store_sales
    union all select 'store', sr_store_sk, sr_returned_date_sk, 0, sr_return_amt, -sr_net_loss from store_returns
    union all select 'catalog', cs_catalog_page_sk, cs_sold_date_sk, cs_ext_sales_price, 0, cs_net_profit from catalog_sales
    union all select 'catalog', cr_catalog_page_sk, cr_returned_date_sk, 0, cr_return_amount, -cr_net_loss from catalog_returns
    union all select 'web', ws_web_site_sk, ws_sold_date_sk, ws_ext_sales_price, 0, ws_net_profit from web_sales
    union all select 'web', ws_web_site_sk, wr_returned_date_sk, 0, wr_return_amt, -wr_net_loss
      from web_returns left join web_sales on ws_item_sk = wr_item_sk and ws_order_number = wr_order_number)
  {_TOTALS} from l join outlets using (ch, k) join date_dim on d_date_sk = dk and {span('1998-08-04', 14)}
  group by rollup (channel, id)""", "channel id")

case("q80", dict(start="1998-08-04", price=50), f"""
  with {_OUTLETS}, s as (
    select 'store' as channel, ss_store_sk as k, ss_sold_date_sk as dk, ss_item_sk as item_sk, ss_promo_sk as pk,
      ss_ticket_number as order_no, ss_ext_sales_price as sales, ss_net_profit as net from store_sales
    union all select 'catalog', cs_catalog_page_sk, cs_sold_date_sk, cs_item_sk, cs_promo_sk, cs_order_number,
      cs_ext_sales_price, cs_net_profit from catalog_sales
    union all select 'web', ws_web_site_sk, ws_sold_date_sk, ws_item_sk, ws_promo_sk, ws_order_number,
      ws_ext_sales_price, ws_net_profit from web_sales),
  l as (
    select s.channel as ch, s.k, s.sales, coalesce(r.return_amt, 0) as returns, net - coalesce(r.net_loss, 0) as profit
    from s left join all_returns r using (channel, item_sk, order_no)
      join date_dim on d_date_sk = dk and {span('1998-08-04', 30)}
      join item on i_item_sk = s.item_sk and i_current_price > 50
      join promotion on p_promo_sk = pk and p_channel_tv = 'N')
  {_TOTALS} from l join outlets using (ch, k) group by rollup (channel, id)""", "channel id")


def _part(fact: str, p: str, key: str, sold: str, cols: str) -> str:
    return (f"select {key} as k, {cols} from {fact} join date_dim on d_date_sk = {p}{sold} "
            f"and {span('1998-08-04', 30)} group by 1")


def _sr(p: str, amt: str) -> str:
    return f"round(sum({p}{amt}), 2) as returns, round(sum({p}net_loss), 2) as loss"


def _ss(p: str) -> str:
    return f"round(sum({p}ext_sales_price), 2) as sales, round(sum({p}net_profit), 2) as net"


case("q77", dict(start="1998-08-04"), f"""
  with ss as ({_part('store_sales', 'ss_', 'ss_store_sk', 'sold_date_sk', _ss('ss_'))}),
  sr as ({_part('store_returns', 'sr_', 'sr_store_sk', 'returned_date_sk', _sr('sr_', 'return_amt'))}),
  cs as ({_part('catalog_sales', 'cs_', 'cs_call_center_sk', 'sold_date_sk', _ss('cs_'))}),
  cr as ({_part('catalog_returns', 'cr_', 'cr_call_center_sk', 'returned_date_sk', _sr('cr_', 'return_amount'))}),
  ws as ({_part('web_sales', 'ws_', 'ws_web_page_sk', 'sold_date_sk', _ss('ws_'))}),
  wr as ({_part('web_returns', 'wr_', 'wr_web_page_sk', 'returned_date_sk', _sr('wr_', 'return_amt'))}),
  l as (
    select 'store channel' as channel, k as id, sales, coalesce(returns, 0) as returns, net - coalesce(loss, 0) as profit
    from ss join store on s_store_sk = k left join sr using (k)
    union all select 'catalog channel', cs.k, sales, returns, net - loss from cs, cr
    union all select 'web channel', k, sales, coalesce(returns, 0), net - coalesce(loss, 0)
    from ws join web_page on wp_web_page_sk = k left join wr using (k))
  {_TOTALS} from l group by rollup (channel, id)""", "channel id")

_CROSS = """cross_items as (
    select i_item_sk from item join (
      select i_brand_id, i_class_id, i_category_id from all_sales join item on i_item_sk = item_sk
        join date_dim on d_date_sk = sold_date_sk and d_year in (1997, 1998, 1999)
      group by all having count(distinct channel) = 3) using (i_brand_id, i_class_id, i_category_id)),
  typical as (
    select round(sum(quantity * list_price), 2) / count(*) as m
    from all_sales join date_dim on d_date_sk = sold_date_sk and d_year in (1997, 1998, 1999))"""

case("q14", dict(year=1997, month=11), f"""
  with {_CROSS}, g as (
    select channel, i_brand_id, i_class_id, i_category_id, round(sum(quantity * list_price), 2) as sales, count(*) as n
    from all_sales join item on i_item_sk = item_sk and i_item_sk in (from cross_items)
      join date_dim on d_date_sk = sold_date_sk and d_year = 1999 and d_moy = 11
    group by all having sales > (from typical))
  select channel, i_brand_id, i_class_id, i_category_id, round(sum(sales), 2) as sum_sales, cast(sum(n) as bigint) as sum_number_sales
  from g group by rollup (channel, i_brand_id, i_class_id, i_category_id)""", "channel i_brand_id i_class_id i_category_id")

case("q14b", dict(year=1997, month=12, dom=16), f"""
  with {_CROSS}, g as (
    select d_week_seq, i_brand_id, i_class_id, i_category_id, round(sum(ss_quantity * ss_list_price), 2) as sales, count(*) as n
    from store_sales join item on i_item_sk = ss_item_sk and i_item_sk in (from cross_items)
      join date_dim on d_date_sk = ss_sold_date_sk group by all having sales > (from typical)),
  a as (from g where d_week_seq = (select d_week_seq from date_dim where d_date = date '1998-12-16')),
  b as (from g where d_week_seq = (select d_week_seq from date_dim where d_date = date '1997-12-16'))
  select 'store' as channel, a.i_brand_id, a.i_class_id, a.i_category_id, a.sales, a.n as number_sales,
    'store' as channel2, b.i_brand_id as i_brand_id2, b.i_class_id as i_class_id2, b.i_category_id as i_category_id2,
    b.sales as sales2, b.n as number_sales2
  from a join b on (a.i_brand_id, a.i_class_id, a.i_category_id) = (b.i_brand_id, b.i_class_id, b.i_category_id)""",
     "channel i_brand_id i_class_id i_category_id")

case("q18", dict(gender="M", education="College", year=1999, states=tuple(f"NATION_{i}" for i in range(7))), f"""
  select i_item_id, ca_country, ca_state, ca_county, avg(cs_quantity) as agg1, {avg2('cs_list_price')} as agg2,
    {avg2('cs_coupon_amt')} as agg3, {avg2('cs_sales_price')} as agg4, {avg2('cs_net_profit')} as agg5,
    avg(c_birth_year) as agg6, avg(buyer.cd_dep_count) as agg7
  from catalog_sales join date_dim on d_date_sk = cs_sold_date_sk and d_year = 1999
    join customer_demographics buyer on buyer.cd_demo_sk = cs_bill_cdemo_sk and cd_gender = 'M' and cd_education_status = 'College'
    join customers on c_customer_sk = cs_bill_customer_sk and c_birth_month in (1, 4, 5, 9, 10, 12)
    join customer_demographics own on own.cd_demo_sk = c_current_cdemo_sk
    join customer_address on ca_address_sk = c_current_addr_sk and ca_state in {tuple(f'NATION_{i}' for i in range(7))}
    join item on i_item_sk = cs_item_sk
  group by rollup (i_item_id, ca_country, ca_state, ca_county)""".replace("and cd_gender", "and buyer.cd_gender").replace(
    "and cd_education", "and buyer.cd_education"), "ca_country ca_state ca_county i_item_id")

case("q22", dict(month=1176), """
  select i_product_name, i_brand, i_class, i_category, avg(inv_quantity_on_hand) as qoh
  from inventory join date_dim on d_date_sk = inv_date_sk and d_month_seq between 1176 and 1187
    join item on i_item_sk = inv_item_sk
  group by rollup (i_product_name, i_brand, i_class, i_category)""", "qoh i_product_name i_brand i_class i_category")

_ST = tuple(f"NATION_{i}" for i in range(0, 20))


def _q27(flag: str) -> str:
    return f"""
  select i_item_id, s_state, {flag} as g_state, avg(ss_quantity) as agg1, {avg2('ss_list_price')} as agg2,
    {avg2('ss_coupon_amt')} as agg3, {avg2('ss_sales_price')} as agg4
  from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_year = 1999
    join customer_demographics on cd_demo_sk = ss_cdemo_sk and cd_gender = 'M' and cd_marital_status = 'W' and cd_education_status = 'College'
    join store on s_store_sk = ss_store_sk and s_state in {_ST} join item on i_item_sk = ss_item_sk
  group by rollup (i_item_id, s_state)"""


case("q27", dict(year=1999, states=_ST), _q27("s_state"), "i_item_id s_state")
case("q27_flag", dict(year=1999, states=_ST, flag=True), _q27("cast(grouping(s_state) as integer)"), "i_item_id s_state")


def _levels(parent: str, child: str, exact: bool) -> tuple[str, str]:
    if exact:
        return (f"cast(grouping({parent}) + grouping({child}) as integer)",
                f"case when grouping({child}) = 0 then {parent} end")
    return (f"cast({parent} is null as integer) + cast({child} is null as integer)",
            f"case when {child} is not null then {parent} end")


def _hierarchy(name: str, params: dict, measure: str, source: str, parent: str, child: str, label: str, order: str) -> None:
    for exact in (False, True):
        level, within = _levels(parent, child, exact)
        case(name + ("_exact" if exact else ""), dict(params, **({"exact": True} if exact else {})), f"""
          select {label}, {parent}, {child}, lochierarchy,
            rank() over (partition by lochierarchy, within order by {label} {order}) as rank_within_parent
          from (select {measure} as {label}, {parent}, {child}, {level} as lochierarchy, {within} as within
                {source} group by rollup ({parent}, {child}))""",
             ["lochierarchy desc nulls last", f"case when lochierarchy = 0 then {parent} end asc nulls first",
              "rank_within_parent asc nulls first"])


_hierarchy("q36", dict(year=2000, states=_ST), "round(sum(ss_net_profit), 2) / round(sum(ss_ext_sales_price), 2)",
           f"""from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_year = 2000
             join item on i_item_sk = ss_item_sk join store on s_store_sk = ss_store_sk and s_state in {_ST}""",
           "i_category", "i_class", "gross_margin", "asc nulls first")
_hierarchy("q86", dict(month=1188), "round(sum(ws_net_paid), 2)",
           """from web_sales join date_dim on d_date_sk = ws_sold_date_sk and d_month_seq between 1188 and 1199
             join item on i_item_sk = ws_item_sk""", "i_category", "i_class", "total_sum", "desc nulls last")
_Q70 = """from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_month_seq between 1188 and 1199
             join store on s_store_sk = ss_store_sk"""
_hierarchy("q70", dict(month=1188), "round(sum(ss_net_profit), 2)", _Q70, "s_state", "s_county", "total_sum", "desc nulls last")
_lv, _wi = _levels("s_state", "s_county", True)
case("q70_best", dict(month=1188, exact=True, best=5), f"""
  with best as (select s_state from (select s_state, rank() over (order by round(sum(ss_net_profit), 2) desc) as r {_Q70} group by 1) where r <= 5)
  select total_sum, s_state, s_county, lochierarchy,
    rank() over (partition by lochierarchy, within order by total_sum desc nulls last) as rank_within_parent
  from (select round(sum(ss_net_profit), 2) as total_sum, s_state, s_county, {_lv} as lochierarchy, {_wi} as within
        {_Q70} and s_state in (from best) group by rollup (s_state, s_county))""",
     ["lochierarchy desc nulls last", "case when lochierarchy = 0 then s_state end asc nulls first",
      "rank_within_parent asc nulls first"])

_K67 = "i_category i_class i_brand i_product_name d_year d_qoy d_moy s_store_id"
case("q67", dict(month=1188), f"""
  select *, rank() over (partition by i_category order by sumsales desc nulls last) as rk
  from (select {_K67.replace(' ', ', ')}, round(sum(coalesce(ss_sales_price * ss_quantity, 0)), 2) as sumsales
        from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_month_seq between 1188 and 1199
          join store on s_store_sk = ss_store_sk join item on i_item_sk = ss_item_sk
        group by rollup ({_K67.replace(' ', ', ')}))
  qualify rk <= 100""", _K67 + " sumsales rk")


# ---- several channels ------------------------------------------------------

def _growth(name: str, channels: tuple, value: str, year: int, pairs: tuple, cols: str, order: str) -> None:
    keys = [f"{c}_{i}" for c in channels for i in (0, 1)]
    cells = ", ".join(value.replace("@", f"(channel = '{k[:-2]}' and d_year = {year + int(k[-1])})") + f" as {k}"
                      for k in keys)
    grow = " and ".join(f"{a}_1 / {a}_0 > {b}_1 / {b}_0" for a, b in pairs)
    case(name, dict(year=year), f"""
      with y as (select customer_sk, {cells} from all_sales join date_dim on d_date_sk = sold_date_sk group by 1)
      select {cols} from y join customers on c_customer_sk = customer_sk
      where {' and '.join(f'{c}_0 > 0' for c in channels)} and {grow}""", order)


_NAMES = "c_customer_id as customer_id, c_first_name as customer_first_name, c_last_name as customer_last_name"
_growth("q4", ("store", "catalog", "web"),
        "round(sum((ext_list_price - ext_wholesale_cost - ext_discount_amt + ext_sales_price) / 2) filter @, 3)", 1998,
        (("catalog", "store"), ("catalog", "web")), _NAMES + ", c_email_address as customer_email_address", "customer_id")
_growth("q11", ("store", "web"), "round(sum(ext_list_price - ext_discount_amt) filter @, 2)", 1998,
        (("web", "store"),), _NAMES + ", c_email_address as customer_email_address", "customer_id")
_growth("q74", ("store", "web"), "max(net_paid) filter @", 1998, (("web", "store"),), _NAMES,
        "customer_first_name customer_id customer_last_name")

case("q31", dict(year=2000), f"""
  with g as (
    select ca_county, d_year, channel, d_qoy, round(sum(ext_sales_price), 2) as v
    from all_sales join customer_address on ca_address_sk = addr_sk
      join date_dim on d_date_sk = sold_date_sk and d_year = 2000 group by all),
  p as (select ca_county, d_year, {', '.join(
      f"max(v) filter (channel = '{c}' and d_qoy = {q}) as {c}{q}" for c in ('store', 'web') for q in (1, 2, 3))}
    from g group by all)
  select ca_county, d_year, web2 / web1 as web_q1_q2_increase, store2 / store1 as store_q1_q2_increase,
    web3 / web2 as web_q2_q3_increase, store3 / store2 as store_q2_q3_increase
  from p where web2 / web1 > store2 / store1 and web3 / web2 > store3 / store2""", "d_year", None)

for _name, _params, _key, _listed, _y, _m, _off, _order in (
        ("q33", dict(category="PROMO", year=1999, month=3, offset=-6), "i_manufact_id", "i_category = 'PROMO'", 1999, 3, -6, "total_sales"),
        ("q56", dict(colours=("red", "old", "hot"), year=2000, month=1, offset=-8), "i_item_id", "i_color in ('red', 'old', 'hot')", 2000, 1, -8, "total_sales"),
        ("q60", dict(category="SMALL", year=1999, month=9, offset=-6), "i_item_id", "i_category = 'SMALL'", 1999, 9, -6, "i_item_id total_sales")):
    case(_name, _params, f"""
      select {_key}, round(sum(ext_sales_price), 2) as total_sales
      from all_sales join item on i_item_sk = item_sk and {_key} in (select {_key} from item where {_listed})
        join date_dim on d_date_sk = sold_date_sk and d_year = {_y} and d_moy = {_m}
        join customer_address on ca_address_sk = addr_sk and ca_gmt_offset = {_off}
      group by {_key}""", _order)

case("q71", dict(manager=1, year=2000, month=12), """
  select i_brand_id as brand_id, i_brand as brand, t_hour, t_minute, round(sum(ext_sales_price), 2) as ext_price
  from all_sales join item on i_item_sk = item_sk and i_manager_id = 1
    join date_dim on d_date_sk = sold_date_sk and d_year = 2000 and d_moy = 12
    join time_dim on t_time_sk = sold_time_sk and t_meal_time in ('breakfast', 'dinner')
  group by all""", "-ext_price brand_id", None)


def _buyers(channel: str, day: str) -> str:
    return (f"select distinct c_last_name, c_first_name, {day} from all_sales join customers on c_customer_sk = customer_sk "
            f"join date_dim on d_date_sk = sold_date_sk and d_month_seq between 1176 and 1187 where channel = '{channel}'")


case("q38", dict(month=1176, day="d_moy"), f"""
  select count(*) as cnt from ({_buyers('store', 'd_moy')} intersect {_buyers('catalog', 'd_moy')} intersect {_buyers('web', 'd_moy')})""")
case("q87", dict(month=1176), f"""
  select count(*) as cnt from (({_buyers('store', 'd_date')} except {_buyers('catalog', 'd_date')}) except {_buyers('web', 'd_date')})""")

case("q97", dict(month=1176), """
  with p as (select distinct channel, customer_sk, item_sk from all_sales
             join date_dim on d_date_sk = sold_date_sk and d_month_seq between 1176 and 1187),
  s as (from p where channel = 'store'), c as (from p where channel = 'catalog')
  select count(*) filter (s.customer_sk is not null and c.customer_sk is null) as store_only,
    count(*) filter (s.customer_sk is null and c.customer_sk is not null) as catalog_only,
    count(*) filter (s.customer_sk is not null and c.customer_sk is not null) as store_and_catalog
  from s full join c on c.customer_sk = s.customer_sk and c.item_sk = s.item_sk""")

case("q75", dict(category="PROMO", year=1999), """
  with l as (
    select distinct d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id,
      quantity - coalesce(return_quantity, 0) as cnt, ext_sales_price - coalesce(return_amt, 0) as amt
    from all_sales s join item on i_item_sk = s.item_sk and i_category = 'PROMO'
      join date_dim on d_date_sk = sold_date_sk
      left join all_returns r on r.channel = s.channel and r.order_no = s.order_no and r.item_sk = s.item_sk),
  y as (select d_year, i_brand_id, i_class_id, i_category_id, i_manufact_id, cast(sum(cnt) as bigint) as cnt,
          round(sum(amt), 2) as amt from l group by all)
  select p.d_year as prev_year, c.d_year as year, i_brand_id, i_class_id, i_category_id, i_manufact_id,
    p.cnt as prev_yr_cnt, c.cnt as curr_yr_cnt, c.cnt - p.cnt as sales_cnt_diff, round(c.amt - p.amt, 2) as sales_amt_diff
  from y c join y p using (i_brand_id, i_class_id, i_category_id, i_manufact_id)
  where c.d_year = 1999 and p.d_year = 1998 and cast(c.cnt as double) / p.cnt < 0.9""", "sales_cnt_diff")


def _q78(extra: str) -> str:
    return f"""
  with k as (
    select s.channel, d_year, s.item_sk, s.customer_sk, cast(sum(quantity) as bigint) as qty,
      round(sum(wholesale_cost), 2) as wc, round(sum(sales_price), 2) as sp
    from all_sales s left join all_returns r using (channel, order_no, item_sk)
      join date_dim on d_date_sk = sold_date_sk
    where r.order_no is null group by all)
  select a.d_year as ss_sold_year, a.item_sk as ss_item_sk, a.customer_sk as ss_customer_sk,
    {half_up('a.qty / coalesce(w.qty + c.qty, 1)')} as ratio, a.qty as store_qty, a.wc as store_wholesale_cost,
    a.sp as store_sales_price, coalesce(w.qty, 0) + coalesce(c.qty, 0) as other_chan_qty,
    round(coalesce(w.wc, 0) + coalesce(c.wc, 0), 2) as other_chan_wholesale_cost,
    round(coalesce(w.sp, 0) + coalesce(c.sp, 0), 2) as other_chan_sales_price
  from k a
    left join k w on w.channel = 'web' and w.d_year = a.d_year and w.item_sk = a.item_sk and w.customer_sk = a.customer_sk
    left join k c on c.channel = 'catalog' and c.d_year = a.d_year and c.customer_sk = a.customer_sk {extra}
  where a.channel = 'store' and a.d_year = 1998 and coalesce(w.qty, 0) > 0 and coalesce(c.qty, 0) > 0"""


_O78 = ("ss_sold_year ss_item_sk ss_customer_sk -store_qty -store_wholesale_cost -store_sales_price other_chan_qty "
        "other_chan_wholesale_cost other_chan_sales_price ratio")
case("q78", dict(year=1998), _q78(""), _O78)
case("q78_by_item", dict(year=1998, by_item=True), _q78("and c.item_sk = a.item_sk"), _O78)

_ZIPS = tuple(f"{i * 37:05d}" for i in range(0, 400, 3))
case("q8", dict(zips=_ZIPS, least=1, quarter=1, year=1999), f"""
  with z as (
    select distinct left(ca_zip, 5) as zip from customer_address where left(ca_zip, 5) in {_ZIPS}
    intersect
    select left(ca_zip, 5) from customer_address join customers on c_current_addr_sk = ca_address_sk
    where c_preferred_cust_flag = 'Y' group by 1 having count(*) > 1)
  select s_store_name, round(sum(ss_net_profit), 2) as net_profit
  from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_qoy = 1 and d_year = 1999
    join store on s_store_sk = ss_store_sk join z on left(s_zip, 2) = left(zip, 2)
  group by 1""", "s_store_name")

_BEST = f"""often as (
    select i_item_sk from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_year between 1996 and 1999
      join item on i_item_sk = ss_item_sk group by left(i_item_desc, 30), i_item_sk, d_date having count(*) > 0),
  spent as (select ss_customer_sk, round(sum(ss_quantity * ss_sales_price), 2) as v,
      round(sum(ss_quantity * ss_sales_price) filter (d_year between 1996 and 1999), 2) as v4
    from store_sales join customers on c_customer_sk = ss_customer_sk left join date_dim on d_date_sk = ss_sold_date_sk group by 1),
  best as (select ss_customer_sk from spent where v > 0.4e0 * (select max(v4) from spent)),
  s as (
    select channel, customer_sk, quantity * list_price as sales from all_sales
      join date_dim on d_date_sk = sold_date_sk and d_year = 1996 and d_moy = 1
    where channel <> 'store' and item_sk in (from often) and customer_sk in (from best))"""
_P23 = dict(year=1996, month=1, least=0, share=0.4)
case("q23", _P23, f"with {_BEST} select round(sum(sales), 2) as sum_sales from s")
case("q23b", _P23, f"""
  with {_BEST}, g as (select channel, c_last_name, c_first_name, round(sum(sales), 2) as sales
    from s join customers on c_customer_sk = customer_sk group by all)
  select c_last_name, c_first_name, sales from g""", "c_last_name c_first_name sales")

for _name, _colour in (("q24", "red"), ("q24b", "old")):
    case(_name, dict(market=7, colour=_colour, share=0.05), f"""
      with p as (
        select c_last_name, c_first_name, s_store_name, ca_state, s_state, i_color, i_current_price, i_manager_id,
          i_units, i_size, round(sum(ss_sales_price), 2) as netpaid
        from store_sales join store_returns on sr_ticket_number = ss_ticket_number and sr_item_sk = ss_item_sk
          join store on s_store_sk = ss_store_sk and s_market_id = 7 join item on i_item_sk = ss_item_sk
          join customers on c_customer_sk = ss_customer_sk
          join customer_address on ca_zip = s_zip and upper(ca_country) = c_birth_country
        group by all)
      select c_last_name, c_first_name, s_store_name, round(sum(netpaid), 2) as paid from p where i_color = '{_colour}'
      group by all having paid > (select 0.05e0 * ({avg2('netpaid')}) from p)""")

case("q54", dict(category="PROMO", item_class="PROMO-1", month=3, year=1999), """
  with mine as (
    select distinct c_customer_sk, c_current_addr_sk from all_sales
      join item on i_item_sk = item_sk and i_category = 'PROMO' and i_class = 'PROMO-1'
      join date_dim on d_date_sk = sold_date_sk and d_year = 1999 and d_moy = 3
      join customers on c_customer_sk = customer_sk where channel <> 'store'),
  r as (
    select c_customer_sk, round(sum(ss_ext_sales_price), 2) as revenue
    from mine join store_sales on ss_customer_sk = c_customer_sk
      join customer_address on ca_address_sk = c_current_addr_sk
      join store on s_county = ca_county and s_state = ca_state
      join date_dim on d_date_sk = ss_sold_date_sk
    where d_month_seq between (select distinct d_month_seq + 1 from date_dim where d_year = 1999 and d_moy = 3)
      and (select distinct d_month_seq + 3 from date_dim where d_year = 1999 and d_moy = 3)
    group by 1),
  g as (select cast(round(revenue / 50) as bigint) as segment from r)
  select segment, count(*) as num_customers, segment * 50 as segment_base from g group by segment""",
     "segment num_customers")

case("q64", dict(colours=("red", "old", "hot", "new", "blue"), price=20, spread=(0, 150), year=1998), """
  with ui as (
    select cs_item_sk from catalog_sales join catalog_returns on cr_item_sk = cs_item_sk and cr_order_number = cs_order_number
    group by 1 having round(sum(cs_ext_list_price), 2) > 2 * round(sum(cr_refunded_cash + cr_reversed_charge + cr_store_credit), 2)),
  x as (
    select i_product_name as product_name, i_item_sk, s_store_name as store_name, s_zip as store_zip,
      b.ca_street_number as b_street_number, b.ca_street_name as b_street_name, b.ca_city as b_city, b.ca_zip as b_zip,
      c.ca_street_number as c_street_number, c.ca_street_name as c_street_name, c.ca_city as c_city, c.ca_zip as c_zip,
      d1.d_year as syear, d2.d_year as fsyear, d3.d_year as s2year, count(*) as cnt,
      round(sum(ss_wholesale_cost), 2) as s1, round(sum(ss_list_price), 2) as s2, round(sum(ss_coupon_amt), 2) as s3
    from store_sales join store_returns on sr_item_sk = ss_item_sk and sr_ticket_number = ss_ticket_number
      join ui on cs_item_sk = ss_item_sk join store on s_store_sk = ss_store_sk
      join customers on c_customer_sk = ss_customer_sk
      join date_dim d1 on d1.d_date_sk = ss_sold_date_sk join date_dim d2 on d2.d_date_sk = c_first_sales_date_sk
      join date_dim d3 on d3.d_date_sk = c_first_shipto_date_sk
      join customer_demographics m1 on m1.cd_demo_sk = ss_cdemo_sk
      join customer_demographics m2 on m2.cd_demo_sk = c_current_cdemo_sk and m2.cd_marital_status <> m1.cd_marital_status
      join promotion on p_promo_sk = ss_promo_sk
      join household_demographics h1 on h1.hd_demo_sk = ss_hdemo_sk join income_band i1 on i1.ib_income_band_sk = h1.hd_income_band_sk
      join household_demographics h2 on h2.hd_demo_sk = c_current_hdemo_sk join income_band i2 on i2.ib_income_band_sk = h2.hd_income_band_sk
      join customer_address b on b.ca_address_sk = ss_addr_sk join customer_address c on c.ca_address_sk = c_current_addr_sk
      join item on i_item_sk = ss_item_sk and i_color in ('red', 'old', 'hot', 'new', 'blue') and i_current_price between 20 and 170
    group by all)
  select p.product_name, p.store_name, p.store_zip, p.b_street_number, p.b_street_name, p.b_city, p.b_zip,
    p.c_street_number, p.c_street_name, p.c_city, p.c_zip, p.syear, p.cnt, p.s1 as s11, p.s2 as s21, p.s3 as s31,
    n.s1 as s12, n.s2 as s22, n.s3 as s32, n.syear as syear2, n.cnt as cnt2
  from x p join x n on n.i_item_sk = p.i_item_sk and n.store_name = p.store_name and n.store_zip = p.store_zip
  where p.syear = 1998 and n.syear = 1999 and n.cnt <= p.cnt""", "product_name store_name cnt2", None)
