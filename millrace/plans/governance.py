"""Column masking by policy, masked-data warnings and role bindings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType

from millrace.operators.lineage import lineage, of_table
from millrace.registry import Tables, query

# value shown instead of a protected one, by type (fixed values)
DEFAULTS = {"string": "''", "bigint": "0", "int": "0", "double": "0.0", "boolean": "false", "date": "date'1970-01-01'",
            "timestamp": "timestamp'1970-01-01'", "timestamp_ntz": "timestamp_ntz'1970-01-01'"}


@dataclass(frozen=True)
class Policy:
    """Protects one column; ``readers`` see it, ``masked_readers`` see the default value."""

    table: str
    column: str
    readers: tuple[str, ...] = ()
    masked_readers: tuple[str, ...] = ()


def default_of(kind: DataType) -> Column:
    name = kind.simpleString()
    return F.expr(DEFAULTS[name]) if name in DEFAULTS else F.lit(None).cast(kind)


def hidden(policies: list[Policy], table: str, user: str) -> list[Policy]:
    return [p for p in policies if p.table == table and user not in p.readers]


def masked(df: DataFrame, table: str, policies: list[Policy], user: str) -> DataFrame:
    """The table as one user may see it."""
    mine = hidden(policies, table, user)
    refused = [p.column for p in mine if user not in p.masked_readers]
    if refused:
        raise PermissionError(f"{user} may not read {', '.join(refused)} of {table}")
    covered = {p.column for p in mine}
    return df.select(*[default_of(f.dataType).alias(f.name) if f.name in covered else F.col(f.name) for f in df.schema])


def may_hold_masked(result: DataFrame, table: DataFrame, name: str, policies: list[Policy], user: str) -> bool:
    """Whether an output column has the name and type of a column hidden from the user."""
    kinds = {f.name: f.dataType for f in table.schema}
    protected = {(p.column, kinds[p.column]) for p in hidden(policies, name, user) if user in p.masked_readers}
    return any((f.name, f.dataType) in protected for f in result.schema)


def mask_use(on_raw: DataFrame, table: DataFrame, name: str, policies: list[Policy], user: str) -> tuple[list[str], set[str]]:
    """Of a query built on the unmasked table: output columns with a column in them that is hidden from the user, and hidden columns it uses in conditions."""
    found = lineage(on_raw)
    sources, wanted = of_table(found, table), {p.column for p in hidden(policies, name, user)}
    mine = {(i, c) for i in sources for c in wanted}
    return [out for out, read in found.shown.items() if read & mine], {c for _, c in found.used & mine}


def masking_applied(on_raw: DataFrame, table: DataFrame, name: str, policies: list[Policy], user: str) -> bool:
    """Whether masking changes the query: it shows a hidden column or picks rows by one."""
    shown, used = mask_use(on_raw, table, name, policies, user)
    return bool(shown or used)


def role_members(bindings: DataFrame) -> DataFrame:
    """One row per role and member of bindings with ``role`` and ``members``."""
    return bindings.select("role", F.explode("members").alias("member")).distinct()


def with_binding(members: DataFrame, role: str, member: str) -> DataFrame:
    added = members.limit(0).sparkSession.createDataFrame([(role, member)], "role string, member string")
    return members.unionByName(added).distinct()


POLICIES = [Policy("customer", "c_acctbal", readers=("auditor",), masked_readers=("analyst",)),
            Policy("customer", "c_name", readers=("auditor",), masked_readers=("analyst",))]


@query
def m1_masked_table(t: Tables):
    seen = masked(t.customer, "customer", POLICIES, "analyst")
    return seen.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("balance"), F.max("c_name").alias("name"))


@query
def m2_m3_masking_flags(t: Tables):
    """A renamed column escapes the comparison by name but not the lineage."""
    renamed = t.customer.select(F.col("c_acctbal").alias("amount"), "c_custkey")
    plain = t.customer.select("c_custkey", "c_mktsegment")
    direct = t.customer.select("c_acctbal", "c_custkey")
    flags = []
    for df in (direct, renamed, plain):
        flags += [F.lit(may_hold_masked(df, t.customer, "customer", POLICIES, "analyst")),
                  F.lit(masking_applied(df, t.customer, "customer", POLICIES, "analyst"))]
    names = ("direct_by_name", "direct_exact", "renamed_by_name", "renamed_exact", "plain_by_name", "plain_exact")
    return t.customer.agg(F.count("*").alias("n"), *[f.alias(n) for f, n in zip(flags, names)])


@query
def m3_column_lineage(t: Tables):
    """Which results of some queries on customers show a hidden column, and which only pick rows by one."""
    c = t.customer
    c.createOrReplaceTempView("lineage_customer")
    region = t.nation.select("n_nationkey", "n_name")
    queries = {
        "renamed": c.select(F.col("c_acctbal").alias("a"), "c_custkey").withColumn("b", F.col("a") * 2).select("b", "c_custkey"),
        "dropped": c.withColumn("b", F.col("c_acctbal") * 2).drop("b", "c_acctbal", "c_name"),
        "filtered": c.where("c_acctbal > 0").select("c_custkey", "c_mktsegment"),
        "grouped": c.groupBy("c_mktsegment").agg(F.max("c_acctbal").alias("top"), F.count("*").alias("n")),
        "joined": c.join(region, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_custkey"),
        "united": c.select(F.col("c_mktsegment").alias("x")).union(c.select("c_name")),
        "viewed": t.spark.sql("select upper(c_name) as who, c_custkey from lineage_customer"),
        "ranked": c.select("c_custkey", F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_acctbal")).alias("r")),
        "subquery": t.spark.sql("select c_custkey from lineage_customer where c_custkey > (select max(c_acctbal) from lineage_customer)"),
        "other_table": t.supplier.select(F.col("s_acctbal").alias("c_acctbal"), F.col("s_name").alias("c_name")),
    }
    rows = []
    for name, df in queries.items():
        shown, used = mask_use(df, c, "customer", POLICIES, "analyst")
        rows.append((name, ",".join(sorted(shown)), ",".join(sorted(used))))
    flags = t.spark.createDataFrame(rows, "query string, shown string, used string")
    return flags.withColumn("customers", c.agg(F.count("*")).scalar())


@query
def m4_role_members(t: Tables):
    """Market segments as roles and customers as members."""
    who = F.concat(F.lit("user:"), F.col("c_name"))
    bindings = t.customer.select(F.concat(F.lit("roles/"), F.lower("c_mktsegment")).alias("role"),
                                 F.array(who, F.concat(F.lit("group:"), F.col("c_nationkey"))).alias("members"))
    return with_binding(role_members(bindings), "roles/owner", "user:root")
