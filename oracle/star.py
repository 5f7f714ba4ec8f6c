"""SQL text of the derived star for the DuckDB side of the check."""

from __future__ import annotations

import re

from millrace.plans.star import derive

DUCKDB = derive.Spelling(
    day_number="datediff('day', date '1900-01-01', cast({0} as date))",
    date_of="(date '1900-01-01' + cast({0} as integer))",
    series="(select range as k from range({0}))",
    snapshots=", (select range as j from range(5)) snap",
)

_RAW = ("lineitem", "orders", "part", "supplier", "nation", "region", "customer")


def _build() -> dict[str, str]:
    sql = derive.statements(DUCKDB)
    names = {n: n for n in list(sql) + list(_RAW)}
    tables = {n: text.format(**names) for n, text in sql.items()}
    shared = ("sold_date_sk", "sold_time_sk", "item_sk", "promo_sk", "quantity", "list_price",
              "sales_price", "wholesale_cost", "ext_sales_price", "ext_list_price",
              "ext_discount_amt", "ext_wholesale_cost", "net_paid", "net_profit")

    def flat(channel: str, p: str, who: str, order: str, outlet: str) -> str:
        cols = ", ".join(f"{p}{c} as {c}" for c in shared)
        return (f"select '{channel}' as channel, {p}{who}customer_sk as customer_sk, "
                f"{p}{who}addr_sk as addr_sk, {p}{order} as order_no, {p}{outlet} as outlet_sk, {cols} from {channel}_sales")

    tables["all_sales"] = " union all ".join(
        [flat("store", "ss_", "", "ticket_number", "store_sk"), flat("catalog", "cs_", "bill_", "order_number", "call_center_sk"),
         flat("web", "ws_", "bill_", "order_number", "web_site_sk")])
    tables["all_returns"] = """
        select 'store' as channel, sr_returned_date_sk as returned_date_sk, sr_item_sk as item_sk,
          sr_ticket_number as order_no, sr_return_quantity as return_quantity,
          sr_return_amt as return_amt, sr_net_loss as net_loss from store_returns
        union all select 'catalog', cr_returned_date_sk, cr_item_sk, cr_order_number,
          cr_return_quantity, cr_return_amount, cr_net_loss from catalog_returns
        union all select 'web', wr_returned_date_sk, wr_item_sk, wr_order_number,
          wr_return_quantity, wr_return_amt, wr_net_loss from web_returns"""
    return tables


TABLES = _build()
_NAMES = re.compile(r"\b(" + "|".join(TABLES) + r")\b")


def _needed(text: str, seen: list[str]) -> list[str]:
    for name in dict.fromkeys(_NAMES.findall(text)):
        if name not in seen and TABLES[name] is not text:
            _needed(TABLES[name], seen)
            seen.append(name)
    return seen


def with_star(body: str) -> str:
    """Prefix a query with the CTEs of the star tables that it names."""
    needed = _needed(body, [])
    if not needed:
        return body
    ctes = ",\n".join(f"{n} as ({TABLES[n]})" for n in needed)
    return f"with {ctes}\n{body}"


def ranked(body: str, order: str | list[str] | None, limit: int | None = 100) -> str:
    """Order with nulls first when ascending, break ties on all columns, and cut."""
    if order is None:
        return with_star(f"select * from ({body}) q")
    terms = list(order) if isinstance(order, list) else [
        f'"{k[1:]}" desc nulls last' if k.startswith("-") else f'"{k}" asc nulls first' for k in order.split()]
    cut = f" limit {limit}" if limit else ""
    return with_star(f"select * from ({body}) q order by {', '.join(terms)}, columns(*) asc nulls first{cut}")
