"""DuckDB SQL for the star reports, with the parameters used on the test star.

``CASES`` maps a report to (parameters, SQL, order, limit).  Ordering names a
column, or ``-column`` for descending; ties are broken on all columns.
"""

from __future__ import annotations

CASES: dict[str, tuple[dict, str, object, int | None]] = {}


def case(name: str, params: dict, sql: str, order=None, limit: int | None = 100) -> None:
    CASES[name] = (params, sql, order, limit)


def span(start: str, days: int) -> str:
    return f"d_date between date '{start}' and date '{start}' + {days}"


def avg2(x: str) -> str:
    """Average of cent amounts as total over count."""
    return f"round(sum({x}), 2) / count({x})"


DAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def weekday_sums(x: str) -> str:
    return ", ".join(f"round(sum({x}) filter (d_day_name = '{d}'), 2) as {d[:3].lower()}_sales" for d in DAYS)


def half_up(x: str) -> str:
    return f"floor(({x}) * 100 + 0.5e0) / 100"


# ---- one level of grouping -------------------------------------------------

case("q3", dict(manufact=36, month=12), """
  select d_year, i_brand_id as brand_id, i_brand as brand, round(sum(ss_ext_sales_price), 2) as sum_agg
  from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_moy = 12
    join item on i_item_sk = ss_item_sk and i_manufact_id = 36
  group by all""", "d_year -sum_agg brand_id")

case("q52", dict(manager=1, year=1998, month=12), """
  select d_year, i_brand_id as brand_id, i_brand as brand, round(sum(ss_ext_sales_price), 2) as ext_price
  from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_moy = 12 and d_year = 1998
    join item on i_item_sk = ss_item_sk and i_manager_id = 1
  group by all""", "d_year -ext_price brand_id")

case("q55", dict(manager=36, year=2000, month=12), """
  select i_brand_id as brand_id, i_brand as brand, round(sum(ss_ext_sales_price), 2) as ext_price
  from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_moy = 12 and d_year = 2000
    join item on i_item_sk = ss_item_sk and i_manager_id = 36
  group by all""", "-ext_price brand_id")

case("q42", dict(manager=1, year=1998, month=12), """
  select d_year, i_category_id, i_category, round(sum(ss_ext_sales_price), 2) as total_sales
  from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_moy = 12 and d_year = 1998
    join item on i_item_sk = ss_item_sk and i_manager_id = 1
  group by all""", "-total_sales d_year i_category_id i_category")

for _name, _fact, _p, _cd in (("q7", "store_sales", "ss_", "cdemo_sk"), ("q26", "catalog_sales", "cs_", "bill_cdemo_sk")):
    case(_name, dict(gender="F", marital="W", education="Primary", year=1998), f"""
      select i_item_id, avg({_p}quantity) as agg1, {avg2(_p + 'list_price')} as agg2,
        {avg2(_p + 'coupon_amt')} as agg3, {avg2(_p + 'sales_price')} as agg4
      from {_fact} join customer_demographics on cd_demo_sk = {_p}{_cd}
        join date_dim on d_date_sk = {_p}sold_date_sk join item on i_item_sk = {_p}item_sk
        join promotion on p_promo_sk = {_p}promo_sk
      where cd_gender = 'F' and cd_marital_status = 'W' and cd_education_status = 'Primary'
        and d_year = 1998 and 'N' in (p_channel_email, p_channel_event)
      group by i_item_id""", "i_item_id")

_NEAR = ("NATION_0", "NATION_5", "NATION_10", "NATION_15", "NATION_20")
_EDU = ("Primary", "Secondary", "College", "2 yr Degree", "4 yr Degree", "Advanced Degree")
_PEOPLE = (("D", "2 yr Degree", 0, 5000), ("S", "Secondary", 0, 9000), ("W", "Advanced Degree", 0, 90000),
           ("M", "Primary", 500, 20000), ("U", "College", 500, 20000))
_AREAS = ((_NEAR[:3], 100, 20000), (_NEAR[3:], 150, 300000), (("NATION_20", "NATION_0"), 0, 25000))
_AREA_SQL = " or ".join(f"(ca_state in {s} and {{p}} between {lo} and {hi})" for s, lo, hi in _AREAS)
_PEOPLE_SQL = " or ".join(f"(cd_marital_status = '{m}' and cd_education_status = '{e}' and ss_sales_price between {lo} and {hi})"
                          for m, e, lo, hi in _PEOPLE)
_PEOPLE13 = tuple(p + (d,) for p in _PEOPLE for d in (1, 3, 5, 7))

case("q13", dict(year=1999, country="AFRICA", people=_PEOPLE13, areas=_AREAS), f"""
  select avg(ss_quantity) as avg_quantity, {avg2('ss_ext_sales_price')} as avg_sales_price,
    {avg2('ss_ext_wholesale_cost')} as avg_wholesale_cost,
    round(sum(ss_ext_wholesale_cost), 2) as sum_wholesale_cost
  from store_sales join store on s_store_sk = ss_store_sk
    join date_dim on d_date_sk = ss_sold_date_sk and d_year = 1999
    join customer_demographics on cd_demo_sk = ss_cdemo_sk
    join household_demographics on hd_demo_sk = ss_hdemo_sk and hd_dep_count in (1, 3, 5, 7)
    join customer_address on ca_address_sk = ss_addr_sk and ca_country = 'AFRICA'
  where ({_PEOPLE_SQL}) and ({_AREA_SQL.format(p='ss_net_profit')})""")

case("q48", dict(year=1998, country="AFRICA", people=_PEOPLE, areas=_AREAS), f"""
  select cast(sum(ss_quantity) as bigint) as sum_quantity
  from store_sales join store on s_store_sk = ss_store_sk
    join date_dim on d_date_sk = ss_sold_date_sk and d_year = 1998
    join customer_demographics on cd_demo_sk = ss_cdemo_sk
    join customer_address on ca_address_sk = ss_addr_sk and ca_country = 'AFRICA'
  where ({_PEOPLE_SQL}) and ({_AREA_SQL.format(p='ss_net_profit')})""")

case("q85", dict(year=1998, country="AFRICA", people=_PEOPLE, areas=_AREAS), f"""
  select substring(r_reason_desc, 1, 20) as reason, avg(ws_quantity) as avg_quantity,
    {avg2('wr_refunded_cash')} as avg_refunded, {avg2('wr_fee')} as avg_fee
  from web_sales
    join web_returns on wr_order_number = ws_order_number and wr_item_sk = ws_item_sk
    join customer_demographics a on a.cd_demo_sk = wr_refunded_cdemo_sk
    join customer_demographics b on b.cd_demo_sk = wr_returning_cdemo_sk
      and (a.cd_marital_status, a.cd_education_status) = (b.cd_marital_status, b.cd_education_status)
    join web_page on wp_web_page_sk = ws_web_page_sk
    join date_dim on d_date_sk = ws_sold_date_sk and d_year = 1998
    join customer_address on ca_address_sk = wr_refunded_addr_sk and ca_country = 'AFRICA'
    join reason on r_reason_sk = wr_reason_sk
  where ({_PEOPLE_SQL.replace('cd_m', 'a.cd_m').replace('cd_e', 'a.cd_e').replace('ss_', 'ws_')})
    and ({_AREA_SQL.format(p='ws_net_profit')})
  group by r_reason_desc""", "reason avg_quantity avg_refunded avg_fee")

case("q15", dict(zips=("00037", "00370", "01480"), states=("NATION_1", "NATION_7"), price=9000, quarter=2, year=2000), """
  select ca_zip, round(sum(cs_sales_price), 2) as total_price
  from catalog_sales join date_dim on d_date_sk = cs_sold_date_sk and d_qoy = 2 and d_year = 2000
    join customers on c_customer_sk = cs_bill_customer_sk
    join customer_address on ca_address_sk = c_current_addr_sk
  where left(ca_zip, 5) in ('00037', '00370', '01480') or ca_state in ('NATION_1', 'NATION_7') or cs_sales_price > 9000
  group by ca_zip""", "ca_zip")

_ITEMS45 = tuple(range(2, 400, 3))
case("q45", dict(zips=("00037", "00370", "01480"), items=_ITEMS45, quarter=2, year=2000), f"""
  select ca_zip, ca_county, round(sum(ws_sales_price), 2) as total_price
  from web_sales join date_dim on d_date_sk = ws_sold_date_sk and d_qoy = 2 and d_year = 2000
    join customers on c_customer_sk = ws_bill_customer_sk
    join customer_address on ca_address_sk = c_current_addr_sk
    join item i on i.i_item_sk = ws_item_sk
  where left(ca_zip, 5) in ('00037', '00370', '01480')
    or exists (from item k where k.i_item_id = i.i_item_id and k.i_item_sk in {_ITEMS45})
  group by all""", "ca_zip ca_county")

case("q19", dict(manager=7, month=11, year=1999), """
  select i_brand_id as brand_id, i_brand as brand, i_manufact_id, i_manufact,
    round(sum(ss_ext_sales_price), 2) as ext_price
  from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_moy = 11 and d_year = 1999
    join item on i_item_sk = ss_item_sk and i_manager_id = 7
    join customers on c_customer_sk = ss_customer_sk
    join customer_address on ca_address_sk = c_current_addr_sk
    join store on s_store_sk = ss_store_sk and left(s_zip, 5) <> left(ca_zip, 5)
  group by all""", "-ext_price brand brand_id i_manufact_id i_manufact")


def _chain(d1: str, d2: str, d3: str) -> str:
    return f"""from store_sales
    join store_returns on sr_ticket_number = ss_ticket_number and sr_item_sk = ss_item_sk and sr_customer_sk = ss_customer_sk
    join catalog_sales on cs_item_sk = sr_item_sk and cs_bill_customer_sk = sr_customer_sk
    join store on s_store_sk = ss_store_sk join item on i_item_sk = ss_item_sk
    where ss_sold_date_sk in (select d_date_sk from date_dim where {d1})
      and sr_returned_date_sk in (select d_date_sk from date_dim where {d2})
      and cs_sold_date_sk in (select d_date_sk from date_dim where {d3})"""


_QUARTERS = tuple(f"{y}Q{q}" for y in range(1995, 2002) for q in (1, 2, 3, 4))
_STATS = ", ".join(f"count({c}) as {n}count, avg({c}) as {n}ave, round(stddev_samp({c}), 6) as {n}stdev, "
                   f"round(stddev_samp({c}) / avg({c}), 6) as {n}cov" for c, n in (
                       ("ss_quantity", "store_sales_quantity"), ("sr_return_quantity", "store_returns_quantity"),
                       ("cs_quantity", "catalog_sales_quantity")))
case("q17", dict(first="1997Q1", later=_QUARTERS),
     f"select i_item_id, i_item_desc, s_state, {_STATS} "
     f"{_chain(chr(100) + '_quarter_name = ' + repr('1997Q1'), f'd_quarter_name in {_QUARTERS}', f'd_quarter_name in {_QUARTERS}')} group by all",
     "i_item_id i_item_desc s_state")
case("q25", dict(year=1999, first=1, last=12), f"""
  select i_item_id, i_item_desc, s_store_id, s_store_name, round(sum(ss_net_profit), 2) as store_sales_profit,
    round(sum(sr_net_loss), 2) as store_returns_loss, round(sum(cs_net_profit), 2) as catalog_sales_profit
  {_chain("d_moy = 1 and d_year = 1999", "d_year = 1999", "d_year = 1999")} group by all""",
     "i_item_id i_item_desc s_store_id s_store_name")
case("q29", dict(year=1997, month=4, window=8, years=4), f"""
  select i_item_id, i_item_desc, s_store_id, s_store_name, cast(sum(ss_quantity) as bigint) as store_sales_quantity,
    cast(sum(sr_return_quantity) as bigint) as store_returns_quantity,
    cast(sum(cs_quantity) as bigint) as catalog_sales_quantity
  {_chain('d_moy = 4 and d_year = 1997', 'd_moy between 4 and 12 and d_year = 1997', 'd_year between 1997 and 2001')}
  group by all""", "i_item_id i_item_desc s_store_id s_store_name")

for _name, _fact, _key, _price, _makers, _start in (
        ("q37", "catalog_sales", "cs_item_sk", 22, tuple(range(1, 100, 2)), "2000-06-02"),
        ("q82", "store_sales", "ss_item_sk", 60, (37, 29, 27, 63), "1999-05-30")):
    case(_name, dict(price=_price, makers=_makers, start=_start), f"""
      select distinct i_item_id, i_item_desc, i_current_price from item
      where i_current_price between {_price} and {_price + 30} and i_manufact_id in {_makers}
        and i_item_sk in (select inv_item_sk from inventory join date_dim on d_date_sk = inv_date_sk
                          where {span(_start, 60)} and inv_quantity_on_hand between 100 and 500)
        and i_item_sk in (select {_key} from {_fact})""", "i_item_id")

case("q43", dict(offset=-6, year=1998), f"""
  select s_store_name, s_store_id, {weekday_sums('ss_sales_price')}
  from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_year = 1998
    join store on s_store_sk = ss_store_sk and s_gmt_offset = -6
  group by all""", "s_store_name s_store_id")


def lag_counts(lag: str) -> str:
    return (f"count(*) filter ({lag} <= 30) as days_30, count(*) filter ({lag} > 30 and {lag} <= 60) as days_31_60, "
            f"count(*) filter ({lag} > 60 and {lag} <= 90) as days_61_90, "
            f"count(*) filter ({lag} > 90 and {lag} <= 120) as days_91_120, count(*) filter ({lag} > 120) as days_gt120")


_STORE_KEYS = "s_store_name s_company_id s_street_number s_street_name s_street_type s_suite_number s_city s_county s_state s_zip"
case("q50", dict(year=2000, month=9), f"""
  select {_STORE_KEYS.replace(' ', ', ')}, {lag_counts('sr_returned_date_sk - ss_sold_date_sk')}
  from store_sales join store_returns on sr_ticket_number = ss_ticket_number and sr_item_sk = ss_item_sk
      and sr_customer_sk = ss_customer_sk
    join store on s_store_sk = ss_store_sk
    join date_dim back on back.d_date_sk = sr_returned_date_sk and back.d_year = 2000 and back.d_moy = 9
    join date_dim out on out.d_date_sk = ss_sold_date_sk
  group by all""", _STORE_KEYS)

for _name, _fact, _p, _join, _label in (
        ("q62", "web_sales", "ws_", "web_site on web_site_sk = ws_web_site_sk", "web_name"),
        ("q99", "catalog_sales", "cs_", "call_center on cc_call_center_sk = cs_call_center_sk", "cc_name")):
    case(_name, dict(month=1188), f"""
      select left(w_warehouse_name, 20) as w_warehouse_name_substr, sm_type, {_label},
        {lag_counts(f'{_p}ship_date_sk - {_p}sold_date_sk')}
      from {_fact} join date_dim on d_date_sk = {_p}ship_date_sk and d_month_seq between 1188 and 1199
        join warehouse on w_warehouse_sk = {_p}warehouse_sk
        join ship_mode on sm_ship_mode_sk = {_p}ship_mode_sk join {_join}
      group by all""", f"w_warehouse_name_substr sm_type {_label}")

case("q61", dict(offset=-8, category="SMALL", year=1997, month=2), """
  with s as (
    select ss_ext_sales_price as price, 'Y' in (p_channel_dmail, p_channel_email, p_channel_tv) as promoted
    from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_year = 1997 and d_moy = 2
      join store on s_store_sk = ss_store_sk and s_gmt_offset = -8
      join item on i_item_sk = ss_item_sk and i_category = 'SMALL'
      join customers on c_customer_sk = ss_customer_sk
      join customer_address on ca_address_sk = c_current_addr_sk and ca_gmt_offset = -8
      left join promotion on p_promo_sk = ss_promo_sk)
  select round(sum(price) filter (promoted), 2) as promotions, round(sum(price), 2) as total,
    round(sum(price) filter (promoted), 2) / round(sum(price), 2) * 100 as share from s""")

case("q79", dict(dep=8, dow=1, year=1998, staff=(200, 295)), """
  select c_last_name, c_first_name, left(s_city, 30) as city, ss_ticket_number, amt, profit
  from (select ss_ticket_number, ss_customer_sk, ss_addr_sk, s_city, round(sum(ss_coupon_amt), 2) as amt,
          round(sum(ss_net_profit), 2) as profit
        from store_sales join date_dim on d_date_sk = ss_sold_date_sk and d_dow = 1 and d_year in (1998, 1999, 2000)
          join store on s_store_sk = ss_store_sk and s_number_employees between 200 and 295
          join household_demographics on hd_demo_sk = ss_hdemo_sk and (hd_dep_count = 8 or hd_vehicle_count > 0)
        group by all) tickets
    join customers on c_customer_sk = ss_customer_sk""", "c_last_name c_first_name city profit")

case("q84", dict(city="city 5", income=32287), """
  select c_customer_id as customer_id, coalesce(c_last_name, '') || ', ' || coalesce(c_first_name, '') as customername
  from customers join customer_address on ca_address_sk = c_current_addr_sk and ca_city = 'city 5'
    join customer_demographics on cd_demo_sk = c_current_cdemo_sk
    join household_demographics on hd_demo_sk = c_current_hdemo_sk
    join income_band on ib_income_band_sk = hd_income_band_sk and ib_lower_bound >= 32287 and ib_upper_bound <= 82287
    join store_returns on sr_cdemo_sk = cd_demo_sk""", "customer_id")

_HALVES = ("h8_30_to_9", "h9_to_9_30", "h9_30_to_10", "h10_to_10_30", "h10_30_to_11", "h11_to_11_30",
           "h11_30_to_12", "h12_to_12_30")
case("q88", dict(store="east"), "select " + ", ".join(
    f"count(*) filter (t_time >= {30600 + i * 1800} and t_time < {32400 + i * 1800}) as {n}" for i, n in enumerate(_HALVES))
     + """ from store_sales join household_demographics on hd_demo_sk = ss_hdemo_sk
      and hd_dep_count in (0, 1, 3) and hd_vehicle_count <= hd_dep_count + 2
    join store on s_store_sk = ss_store_sk and s_store_name = 'east' join time_dim on t_time_sk = ss_sold_time_sk""")
case("q96", dict(store="east", dep=5, hour=8), """
  select count(*) as cnt from store_sales join household_demographics on hd_demo_sk = ss_hdemo_sk and hd_dep_count = 5
    join time_dim on t_time_sk = ss_sold_time_sk and t_time >= 30600 and t_time < 32400
    join store on s_store_sk = ss_store_sk and s_store_name = 'east'""")
case("q90", dict(dep=8, morning=6, evening=14, chars=(5000, 6000)), """
  select count(*) filter (t_hour in (6, 7)) / count(*) filter (t_hour in (14, 15)) as am_pm_ratio
  from web_sales join household_demographics on hd_demo_sk = ws_ship_hdemo_sk and hd_dep_count = 8
    join web_page on wp_web_page_sk = ws_web_page_sk and wp_char_count between 5000 and 6000
    join time_dim on t_time_sk = ws_sold_time_sk""")

case("q91", dict(year=1999, month=11, offset=-7, potential="%00%", people=tuple(
    (m, e) for m in "MWD" for e in ("Unknown", "Advanced Degree", "Primary"))), """
  select cc_call_center_id as call_center, cc_name as call_center_name, cc_manager as manager,
    round(sum(cr_net_loss), 2) as returns_loss
  from catalog_returns join date_dim on d_date_sk = cr_returned_date_sk and d_year = 1999 and d_moy = 11
    join call_center on cc_call_center_sk = cr_call_center_sk
    join customers on c_customer_sk = cr_returning_customer_sk
    join customer_demographics on cd_demo_sk = c_current_cdemo_sk and cd_marital_status in ('M', 'W', 'D')
      and cd_education_status in ('Unknown', 'Advanced Degree', 'Primary')
    join household_demographics on hd_demo_sk = c_current_hdemo_sk and hd_buy_potential like '%00%'
    join customer_address on ca_address_sk = c_current_addr_sk and ca_gmt_offset = -7
  group by cc_call_center_id, cc_name, cc_manager, cd_marital_status, cd_education_status""", "-returns_loss", None)
