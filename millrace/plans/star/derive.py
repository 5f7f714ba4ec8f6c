"""Retail star derived from the order/line-item tables.

Each entry of :func:`statements` is one SELECT over other entries or over the
raw tables, written with ``{name}`` placeholders.  The few functions that Spark
and an independent SQL checker spell differently come from a :class:`Spelling`.

Money is kept in doubles that always hold whole cents, so sums rounded to cents
do not depend on the order in which partitions are merged.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Spelling:
    """Dialect-dependent function spellings."""

    day_number: str  # timestamp column -> days since 1900-01-01
    date_of: str  # days since 1900-01-01 -> date
    series: str  # relation with one bigint column k in [0, n)
    snapshots: str  # relation suffix that repeats a row for j in 0..4


SPARK = Spelling(
    day_number="cast(datediff(to_date({0}), date'1900-01-01') as bigint)",
    date_of="date_add(date'1900-01-01', cast({0} as int))",
    series="(select id as k from range({0}))",
    snapshots="lateral view explode(sequence(0, 4)) snap as j",
)

# 1995-01-01 and the number of days up to 2002-12-31
FIRST_DAY = 34698
N_DAYS = 2922


def cents(x: str) -> str:
    """Round to cents with plain IEEE arithmetic, the same in every engine."""
    return f"floor(({x}) * 100 + 0.5e0) / 100"


def floordiv(a: str, b: int) -> str:
    return f"cast(floor(({a}) / {b}) as bigint)"


def pick(values: list[str], index: str) -> str:
    """Text chosen from a short list by a zero-based integer expression."""
    arms = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} {arms} end"


def key_text(prefix: str, key: str, width: int = 8) -> str:
    return f"concat('{prefix}', lpad(cast({key} as varchar(20)), {width}, '0'))"


def place(p: str, key: str) -> str:
    """Address columns shared by every located dimension."""
    return f"""
        cast({key} % 900 as varchar(20)) as {p}street_number,
        concat('{{street}} ', cast({key} % 60 as varchar(20))) as {p}street_name,
        {pick(['Ave', 'Blvd', 'Ct', 'Way'], f'{key} % 4')} as {p}street_type,
        concat('Suite ', cast({key} % 50 as varchar(20))) as {p}suite_number,
        concat('city ', cast({key} % 20 as varchar(20))) as {p}city,
        concat(n_name, ' county ', cast({key} % 4 as varchar(20))) as {p}county,
        n_name as {p}state,
        lpad(cast(({key} % 400) * 37 as varchar(20)), 5, '0') as {p}zip,
        r_name as {p}country,
        cast(-(5 + n_nationkey % 4) as double) as {p}gmt_offset""".replace("{street}", "Elm")


LOCATED = """from {supplier} join {nation} on s_nationkey = n_nationkey
        join {region} on n_regionkey = r_regionkey"""


def statements(sp: Spelling) -> dict[str, str]:
    day = sp.day_number.format
    date = sp.date_of.format
    ends = "cast(null as date)"
    out: dict[str, str] = {}

    out["line"] = f"""
        select l_orderkey as ok, cast(l_linenumber as bigint) as ln, l_orderkey % 3 as channel,
          {floordiv('l_partkey', 8)} * 8 + {floordiv('l_partkey', 8)} % 8 as item_sk, l_suppkey as outlet_sk, o_custkey as cust,
          {day('o_orderdate')} as sold_sk,
          {day('o_orderdate')} + 1 + (l_orderkey * 7 + l_linenumber) % 130 as ship_sk,
          (l_orderkey * 911 + l_linenumber * 37) % 86400 as time_sk,
          case when l_orderkey % 97 = 0 then null else o_custkey end as customer_sk,
          case when (l_orderkey + l_linenumber) % 25 = 0 then null
               else 1 + (o_custkey + l_linenumber) % 60 end as hdemo_sk,
          case when (l_orderkey + l_linenumber) % 25 = 1 then null
               else 1 + o_custkey % 70 end as cdemo_sk,
          case when (l_orderkey + l_linenumber) % 25 = 2 then null
               when l_orderkey % 2 = 0 then o_custkey
               else {floordiv('o_custkey', 2)} end as addr_sk,
          case when (l_orderkey + l_linenumber) % 25 = 3 then null
               else 1 + l_orderkey % 20 end as page_sk,
          case when (l_orderkey + l_linenumber) % 25 = 4 then null
               when l_linenumber % 2 = 0 then l_suppkey
               else {floordiv('l_suppkey', 2)} end as warehouse_sk,
          case when (l_orderkey + l_linenumber) % 10 = 5 then null
               else 1 + l_partkey % 50 end as promo_sk,
          1 + (l_orderkey + l_linenumber) % 20 as ship_mode_sk,
          1 + l_partkey % 100 as catalog_page_sk,
          1 + l_orderkey % 20 as reason_sk,
          l_returnflag as flag, l_tax as tax_rate, l_discount as disc_rate,
          cast(l_quantity as bigint) as qty,
          {cents('l_extendedprice / l_quantity')} as list_price
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey"""

    out["priced"] = f"""
        select *, {cents('list_price * (1 - disc_rate)')} as sales_price,
          {cents('list_price * 0.6e0')} as wholesale_cost,
          {cents('list_price * qty')} as ext_list_price
        from {{line}}"""

    out["extended"] = f"""
        select *, {cents('sales_price * qty')} as ext_sales_price,
          {cents('ext_list_price - sales_price * qty')} as ext_discount_amt,
          {cents('wholesale_cost * qty')} as ext_wholesale_cost,
          case when ln = 1 then {cents('sales_price * qty * 0.05e0')} else 0e0 end as coupon_amt,
          {cents('2.5e0 * qty + ok % 10')} as ext_ship_cost
        from {{priced}}"""

    out["sale"] = f"""
        select *, {cents('ext_sales_price - coupon_amt')} as net_paid,
          {cents('(ext_sales_price - coupon_amt) * tax_rate')} as ext_tax,
          {cents('(ext_sales_price - coupon_amt) * (1 + tax_rate)')} as net_paid_inc_tax,
          {cents('ext_sales_price - coupon_amt + ext_ship_cost')} as net_paid_inc_ship,
          {cents('(ext_sales_price - coupon_amt) * (1 + tax_rate) + ext_ship_cost')} as net_paid_inc_ship_tax,
          {cents('ext_sales_price - coupon_amt - ext_wholesale_cost')} as net_profit
        from {{extended}}"""

    measures = ["quantity", "wholesale_cost", "list_price", "sales_price", "ext_discount_amt",
                "ext_sales_price", "ext_wholesale_cost", "ext_list_price", "ext_tax", "coupon_amt"]

    def sale_measures(p: str, more: list[str]) -> str:
        cols = ["qty as " + p + "quantity"] + [f"{m} as {p}{m}" for m in measures[1:] + more]
        return ", ".join(cols)

    paid = ["net_paid", "net_paid_inc_tax", "net_profit"]
    shipped = ["ext_ship_cost", "net_paid", "net_paid_inc_tax", "net_paid_inc_ship",
               "net_paid_inc_ship_tax", "net_profit"]

    out["store_sales"] = f"""
        select sold_sk as ss_sold_date_sk, time_sk as ss_sold_time_sk, item_sk as ss_item_sk,
          customer_sk as ss_customer_sk, cdemo_sk as ss_cdemo_sk, hdemo_sk as ss_hdemo_sk,
          addr_sk as ss_addr_sk, outlet_sk as ss_store_sk, promo_sk as ss_promo_sk,
          ok as ss_ticket_number, {sale_measures('ss_', paid)}
        from {{sale}} where channel = 0"""

    def remote_sale(p: str, channel: int, outlet: str) -> str:
        return f"""
        select sold_sk as {p}sold_date_sk, time_sk as {p}sold_time_sk, ship_sk as {p}ship_date_sk,
          item_sk as {p}item_sk, customer_sk as {p}bill_customer_sk, cdemo_sk as {p}bill_cdemo_sk,
          hdemo_sk as {p}bill_hdemo_sk, addr_sk as {p}bill_addr_sk,
          case when ok % 89 = 0 then null else cust end as {p}ship_customer_sk,
          cdemo_sk as {p}ship_cdemo_sk, hdemo_sk as {p}ship_hdemo_sk, addr_sk as {p}ship_addr_sk,
          {outlet}, ship_mode_sk as {p}ship_mode_sk, warehouse_sk as {p}warehouse_sk,
          promo_sk as {p}promo_sk, ok as {p}order_number, {sale_measures(p, shipped)}
        from {{sale}} where channel = {channel}"""

    out["catalog_sales"] = remote_sale(
        "cs_", 1, "outlet_sk as cs_call_center_sk, catalog_page_sk as cs_catalog_page_sk")
    out["web_sales"] = remote_sale(
        "ws_", 2, "outlet_sk as ws_web_site_sk, page_sk as ws_web_page_sk")

    out["returned"] = f"""
        select *, ship_sk + 1 + ok % 60 as ret_sk, (time_sk + 7200) % 86400 as ret_time_sk,
          {floordiv('qty + 1', 2)} as ret_qty,
          {cents(f"net_paid * {floordiv('qty + 1', 2)} / qty")} as amt
        from {{sale}} where flag = 'R'"""

    out["refunded"] = f"""
        select *, {cents('amt * tax_rate')} as ret_tax, {cents('amt * (1 + tax_rate)')} as amt_inc_tax,
          cast(1 + ok % 90 as double) as fee, {cents('2.5e0 * ret_qty')} as ret_ship_cost,
          {cents('amt * 0.5e0')} as refunded_cash, {cents('amt * 0.3e0')} as reversed_charge,
          {cents('amt * 0.2e0')} as credit, {cents('amt * 0.1e0 + 0.5e0')} as net_loss,
          case when ok % 2 = 0 then cdemo_sk else 1 + (cust + 35) % 70 end as returning_cdemo_sk
        from {{returned}}"""

    def return_measures(p: str, amount: str, credit: str) -> str:
        return f"""ret_qty as {p}return_quantity, amt as {p}{amount}, ret_tax as {p}return_tax,
          amt_inc_tax as {p}return_amt_inc_tax, fee as {p}fee, ret_ship_cost as {p}return_ship_cost,
          refunded_cash as {p}refunded_cash, reversed_charge as {p}reversed_charge,
          credit as {p}{credit}, net_loss as {p}net_loss"""

    out["store_returns"] = f"""
        select ret_sk as sr_returned_date_sk, ret_time_sk as sr_return_time_sk, item_sk as sr_item_sk,
          customer_sk as sr_customer_sk, cdemo_sk as sr_cdemo_sk, hdemo_sk as sr_hdemo_sk,
          addr_sk as sr_addr_sk, outlet_sk as sr_store_sk, reason_sk as sr_reason_sk,
          ok as sr_ticket_number, {return_measures('sr_', 'return_amt', 'store_credit')}
        from {{refunded}} where channel = 0"""

    def remote_return(p: str, channel: int, outlet: str, amount: str, credit: str) -> str:
        return f"""
        select ret_sk as {p}returned_date_sk, ret_time_sk as {p}returned_time_sk, item_sk as {p}item_sk,
          customer_sk as {p}refunded_customer_sk, cdemo_sk as {p}refunded_cdemo_sk,
          hdemo_sk as {p}refunded_hdemo_sk, addr_sk as {p}refunded_addr_sk,
          customer_sk as {p}returning_customer_sk, returning_cdemo_sk as {p}returning_cdemo_sk,
          hdemo_sk as {p}returning_hdemo_sk, addr_sk as {p}returning_addr_sk,
          {outlet}, reason_sk as {p}reason_sk, ok as {p}order_number,
          {return_measures(p, amount, credit)}
        from {{refunded}} where channel = {channel}"""

    out["catalog_returns"] = remote_return(
        "cr_", 1, "outlet_sk as cr_call_center_sk, catalog_page_sk as cr_catalog_page_sk, "
        "ship_mode_sk as cr_ship_mode_sk, warehouse_sk as cr_warehouse_sk",
        "return_amount", "store_credit")
    out["web_returns"] = remote_return(
        "wr_", 2, "page_sk as wr_web_page_sk", "return_amt", "account_credit")

    # five weekly stock snapshots after each sold line, one row per day, item and depot
    out["inventory"] = f"""
        select inv_date_sk, inv_item_sk, inv_warehouse_sk, max(stock) as inv_quantity_on_hand
        from (select {floordiv('sold_sk', 7)} * 7 + 7 * j as inv_date_sk, item_sk as inv_item_sk,
                outlet_sk % 10 as inv_warehouse_sk,
                case when (ok + j) % 4 = 0 then qty * 10 else ok % 7 + j end as stock
              from {{line}} {sp.snapshots}) snapshots
        group by inv_date_sk, inv_item_sk, inv_warehouse_sk"""

    out["item"] = f"""
        select p_partkey as i_item_sk, {key_text('I', floordiv('p_partkey', 2))} as i_item_id,
          {date(f'{FIRST_DAY} + p_partkey % 365')} as i_rec_start_date, {ends} as i_rec_end_date,
          concat('A ', p_name, ' made by ', p_brand, ' in size ', cast(p_size as varchar(20))) as i_item_desc,
          {cents('p_retailprice * (1 + p_partkey % 10) / 50')} as i_current_price,
          {cents('p_retailprice * (1 + p_partkey % 10) * 0.012e0')} as i_wholesale_cost,
          cast(substring(p_brand, 7) as bigint) as i_brand_id, p_brand as i_brand,
          cast(1 + p_size % 5 as bigint) as i_class_id,
          case when p_partkey % 47 = 0 then null
               else concat(p_type, '-', cast(p_size % 5 as varchar(20))) end as i_class,
          cast(case p_type when 'ECONOMY' then 1 when 'STANDARD' then 2 when 'PROMO' then 3
               when 'SMALL' then 4 when 'MEDIUM' then 5 else 6 end as bigint) as i_category_id,
          case when p_partkey % 41 = 0 then null else p_type end as i_category,
          p_partkey % 100 as i_manufact_id,
          concat('maker ', cast(p_partkey % 100 as varchar(20))) as i_manufact,
          {pick(['petite', 'small', 'medium', 'large', 'extra large'], 'p_size % 5')} as i_size,
          concat('form ', cast(p_partkey % 60 as varchar(20))) as i_formulation,
          split_part(p_name, ' ', 1) as i_color,
          {pick(['Each', 'Box', 'Pound', 'Bunch', 'Gross'], 'p_partkey % 5')} as i_units,
          'Unknown' as i_container, p_partkey % 40 as i_manager_id,
          concat(p_name, ' ', cast(p_partkey % 300 as varchar(20))) as i_product_name
        from {{part}}"""

    out["store"] = f"""
        select s_suppkey as s_store_sk, {key_text('S', 's_suppkey')} as s_store_id,
          {date(f'{FIRST_DAY} + s_suppkey')} as s_rec_start_date, {ends} as s_rec_end_date,
          cast(null as bigint) as s_closed_date_sk,
          {pick(['north', 'south', 'east', 'west', 'centre'], 's_suppkey % 5')} as s_store_name,
          200 + s_suppkey % 100 as s_number_employees, 5000000 + s_suppkey * 100 as s_floor_space,
          '8AM-8PM' as s_hours, s_name as s_manager, s_suppkey % 10 as s_market_id,
          'Unknown' as s_geography_class, concat('market ', r_name) as s_market_desc,
          s_name as s_market_manager, cast(1 as bigint) as s_division_id, 'Unknown' as s_division_name,
          1 + s_suppkey % 3 as s_company_id,
          {pick(['acme', 'bolt', 'crest'], 's_suppkey % 3')} as s_company_name,
          {place('s_', 's_suppkey')}, cast(s_suppkey % 11 as double) / 100 as s_tax_percentage
        {LOCATED}"""

    out["warehouse"] = f"""
        select s_suppkey as w_warehouse_sk, {key_text('W', 's_suppkey')} as w_warehouse_id,
          concat('Depot ', cast({floordiv('s_suppkey', 2)} as varchar(20)), ' of ', r_name) as w_warehouse_name,
          50000 + s_suppkey * 977 as w_warehouse_sq_ft, {place('w_', 's_suppkey')}
        {LOCATED}"""

    out["web_site"] = f"""
        select s_suppkey as web_site_sk, {key_text('B', 's_suppkey')} as web_site_id,
          {date(f'{FIRST_DAY} + s_suppkey')} as web_rec_start_date, {ends} as web_rec_end_date,
          concat('site ', cast(s_suppkey % 8 as varchar(20))) as web_name,
          {FIRST_DAY} + s_suppkey as web_open_date_sk, cast(null as bigint) as web_close_date_sk,
          'Unknown' as web_class, s_name as web_manager, s_suppkey % 6 as web_mkt_id,
          'Unknown' as web_mkt_class, concat('market ', r_name) as web_mkt_desc,
          s_name as web_market_manager, 1 + s_suppkey % 3 as web_company_id,
          {pick(['acme', 'bolt', 'crest'], 's_suppkey % 3')} as web_company_name,
          {place('web_', 's_suppkey')}, cast(s_suppkey % 11 as double) / 100 as web_tax_percentage
        {LOCATED}"""

    out["call_center"] = f"""
        select s_suppkey as cc_call_center_sk, {key_text('L', 's_suppkey')} as cc_call_center_id,
          {date(f'{FIRST_DAY} + s_suppkey')} as cc_rec_start_date, {ends} as cc_rec_end_date,
          cast(null as bigint) as cc_closed_date_sk, {FIRST_DAY} + s_suppkey as cc_open_date_sk,
          concat('centre ', cast(s_suppkey % 9 as varchar(20))) as cc_name, 'large' as cc_class,
          100 + s_suppkey as cc_employees, 10000 + s_suppkey * 10 as cc_sq_ft, '8AM-8PM' as cc_hours,
          s_name as cc_manager, s_suppkey % 6 as cc_mkt_id, 'Unknown' as cc_mkt_class,
          concat('market ', r_name) as cc_mkt_desc, s_name as cc_market_manager,
          cast(1 as bigint) as cc_division, 'Unknown' as cc_division_name,
          1 + s_suppkey % 3 as cc_company,
          {pick(['acme', 'bolt', 'crest'], 's_suppkey % 3')} as cc_company_name,
          {place('cc_', 's_suppkey')}, cast(s_suppkey % 11 as double) / 100 as cc_tax_percentage
        {LOCATED}"""

    out["customers"] = f"""
        select c_custkey as c_customer_sk, {key_text('C', 'c_custkey', 10)} as c_customer_id,
          1 + (c_custkey + 2) % 70 as c_current_cdemo_sk, 1 + c_custkey % 60 as c_current_hdemo_sk,
          c_custkey as c_current_addr_sk, {FIRST_DAY} + 30 + c_custkey % 2000 as c_first_shipto_date_sk,
          {FIRST_DAY} + c_custkey % 2000 as c_first_sales_date_sk,
          {pick(['Mr.', 'Ms.', 'Dr.'], 'c_custkey % 3')} as c_salutation,
          concat('First', cast(c_custkey % 30 as varchar(20))) as c_first_name,
          case when c_custkey % 53 = 0 then null
               else concat('Last', cast(c_custkey % 50 as varchar(20))) end as c_last_name,
          case when c_custkey % 2 = 0 then 'Y' else 'N' end as c_preferred_cust_flag,
          1 + c_custkey % 28 as c_birth_day, 1 + c_custkey % 12 as c_birth_month,
          1930 + c_custkey % 60 as c_birth_year, upper(r_name) as c_birth_country,
          lower(c_name) as c_login, concat(lower(c_name), '@example.org') as c_email_address,
          {FIRST_DAY} + 900 + c_custkey % 1500 as c_last_review_date_sk
        from {{customer}} join {{nation}} on c_nationkey = n_nationkey
          join {{region}} on n_regionkey = r_regionkey"""

    out["customer_address"] = f"""
        select c_custkey as ca_address_sk, {key_text('A', 'c_custkey', 10)} as ca_address_id,
          {place('ca_', 'c_custkey')},
          {pick(['condo', 'apartment', 'single family'], 'c_custkey % 3')} as ca_location_type
        from {{customer}} join {{nation}} on c_nationkey = n_nationkey
          join {{region}} on n_regionkey = r_regionkey"""

    out["customer_demographics"] = f"""
        select k + 1 as cd_demo_sk, case when k % 2 = 0 then 'M' else 'F' end as cd_gender,
          {pick(['M', 'S', 'D', 'W', 'U'], floordiv('k', 2) + ' % 5')} as cd_marital_status,
          {pick(['Primary', 'Secondary', 'College', '2 yr Degree', '4 yr Degree',
                 'Advanced Degree', 'Unknown'], floordiv('k', 10))} as cd_education_status,
          500 * (1 + k % 20) as cd_purchase_estimate,
          {pick(['Low Risk', 'Good', 'High Risk', 'Unknown'], 'k % 4')} as cd_credit_rating,
          k % 7 as cd_dep_count, k % 5 as cd_dep_employed_count, k % 4 as cd_dep_college_count
        from {sp.series.format(70)} demo"""

    out["household_demographics"] = f"""
        select k + 1 as hd_demo_sk, 1 + k % 20 as hd_income_band_sk,
          {pick(['0-500', '501-1000', '1001-5000', '5001-10000', '>10000', 'Unknown'], 'k % 6')}
            as hd_buy_potential,
          k % 10 as hd_dep_count, {floordiv('k', 10)} - 1 as hd_vehicle_count
        from {sp.series.format(60)} demo"""

    out["income_band"] = f"""
        select k + 1 as ib_income_band_sk, k * 10000 as ib_lower_bound,
          (k + 1) * 10000 as ib_upper_bound
        from {sp.series.format(20)} band"""

    out["calendar"] = f"""
        select {FIRST_DAY} + k as sk, {date(f'{FIRST_DAY} + k')} as dt
        from {sp.series.format(N_DAYS)} days"""

    weekday = "(sk + 1) % 7"
    qoy = "cast(quarter(dt) as bigint)"
    y, m, d = (f"cast({f}(dt) as bigint)" for f in ("year", "month", "day"))
    out["date_dim"] = f"""
        select sk as d_date_sk, {key_text('D', 'sk')} as d_date_id, dt as d_date,
          ({y} - 1900) * 12 + {m} - 1 as d_month_seq, {floordiv('sk', 7)} as d_week_seq,
          ({y} - 1900) * 4 + {qoy} - 1 as d_quarter_seq, {y} as d_year, {weekday} as d_dow,
          {m} as d_moy, {d} as d_dom, {qoy} as d_qoy, {y} as d_fy_year,
          ({y} - 1900) * 4 + {qoy} - 1 as d_fy_quarter_seq, {floordiv('sk', 7)} as d_fy_week_seq,
          {pick(['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'], weekday)}
            as d_day_name,
          concat(cast({y} as varchar(20)), 'Q', cast({qoy} as varchar(20))) as d_quarter_name,
          case when {m} = 12 and {d} = 25 then 'Y' else 'N' end as d_holiday,
          case when {weekday} in (0, 6) then 'Y' else 'N' end as d_weekend,
          case when {m} = 12 and {d} = 26 then 'Y' else 'N' end as d_following_holiday,
          sk - {d} + 1 as d_first_dom, sk - {d} + 28 as d_last_dom, sk - 365 as d_same_day_ly,
          sk - 91 as d_same_day_lq, 'N' as d_current_day, 'N' as d_current_week,
          'N' as d_current_month, 'N' as d_current_quarter, 'N' as d_current_year
        from {{calendar}}"""

    hour, minute = floordiv("k", 3600), floordiv("k % 3600", 60)
    out["time_dim"] = f"""
        select k as t_time_sk, {key_text('T', 'k')} as t_time_id, k as t_time, {hour} as t_hour,
          {minute} as t_minute, k % 60 as t_second,
          case when {hour} < 12 then 'AM' else 'PM' end as t_am_pm,
          {pick(['third', 'first', 'second'], floordiv('k', 28800))} as t_shift,
          {pick(['night', 'morning', 'afternoon', 'evening'], floordiv('k', 21600))} as t_sub_shift,
          case when {hour} between 6 and 8 then 'breakfast' when {hour} between 12 and 13 then 'lunch'
               when {hour} between 18 and 20 then 'dinner' end as t_meal_time
        from {sp.series.format(86400)} seconds"""

    def yes(modulus: int) -> str:
        return f"case when k % {modulus} = 0 then 'Y' else 'N' end"

    out["promotion"] = f"""
        select k + 1 as p_promo_sk, {key_text('P', 'k + 1')} as p_promo_id,
          {FIRST_DAY} + k * 10 as p_start_date_sk, {FIRST_DAY} + k * 10 + 60 as p_end_date_sk,
          k + 1 as p_item_sk, 1000e0 as p_cost, cast(1 as bigint) as p_response_target,
          concat('promo ', cast(k as varchar(20))) as p_promo_name, {yes(2)} as p_channel_dmail,
          {yes(5)} as p_channel_email, {yes(3)} as p_channel_catalog, {yes(7)} as p_channel_tv,
          {yes(11)} as p_channel_radio, {yes(13)} as p_channel_press, {yes(4)} as p_channel_event,
          {yes(17)} as p_channel_demo, 'details' as p_channel_details, 'Unknown' as p_purpose,
          'N' as p_discount_active
        from {sp.series.format(50)} promo"""

    out["reason"] = f"""
        select k + 1 as r_reason_sk, {key_text('R', 'k + 1')} as r_reason_id,
          concat('reason ', cast(k + 1 as varchar(20))) as r_reason_desc
        from {sp.series.format(20)} why"""

    out["ship_mode"] = f"""
        select k + 1 as sm_ship_mode_sk, {key_text('M', 'k + 1')} as sm_ship_mode_id,
          {pick(['EXPRESS', 'REGULAR', 'OVERNIGHT', 'LIBRARY'], 'k % 4')} as sm_type,
          {pick(['AIR', 'SURFACE', 'SEA'], 'k % 3')} as sm_code,
          concat('CARRIER', cast(k % 5 as varchar(20))) as sm_carrier,
          concat('contract ', cast(k as varchar(20))) as sm_contract
        from {sp.series.format(20)} mode"""

    out["web_page"] = f"""
        select k + 1 as wp_web_page_sk, {key_text('G', 'k + 1')} as wp_web_page_id,
          {date(f'{FIRST_DAY} + k')} as wp_rec_start_date, {ends} as wp_rec_end_date,
          {FIRST_DAY} + k as wp_creation_date_sk, {FIRST_DAY} + 100 + k as wp_access_date_sk,
          'N' as wp_autogen_flag, cast(null as bigint) as wp_customer_sk,
          'http://www.example.org' as wp_url,
          {pick(['order', 'review', 'feedback'], 'k % 3')} as wp_type,
          4000 + k * 150 as wp_char_count, 2 + k % 20 as wp_link_count, k % 7 as wp_image_count,
          k % 4 as wp_max_ad_count
        from {sp.series.format(20)} page"""

    out["catalog_page"] = f"""
        select k + 1 as cp_catalog_page_sk, {key_text('K', 'k + 1')} as cp_catalog_page_id,
          {FIRST_DAY} + k as cp_start_date_sk, {FIRST_DAY} + 90 + k as cp_end_date_sk,
          'DEPARTMENT' as cp_department, 1 + {floordiv('k', 10)} as cp_catalog_number,
          1 + k % 10 as cp_catalog_page_number, concat('page ', cast(k as varchar(20))) as cp_description,
          {pick(['monthly', 'quarterly', 'bi-annual'], 'k % 3')} as cp_type
        from {sp.series.format(100)} page"""

    return out
