"""Log lines of the form ``{user: payload}`` as typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.text import empty_if_null, empty_list_if_null

# fields of the three repeated payloads (fixed values)
GRANT_BLOCK = ("geoCity", "geoCountry", "geoRegion", "ip", "target", "username")
SSO_ACCESS = ("authLevel", "geoCity", "geoCountry", "geoRegion", "ip", "userAgent", "username")
TUNNEL_BLOCK = ("ip", "target", "username")
# list fields of the flat payload with their element types (fixed values)
APP_ACCESS = (("target", "string"), ("authLevel", "int"), ("geolocation", "string"), ("userAgent", "string"),
              ("appflag", "string"), ("ip", "string"))


def repeated_records(lines: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """``{user: [{...}, ...]}`` with a ``dt`` column -> userkey, rec, dt."""
    kind = "array<struct<" + ", ".join(f"{f}: string" for f in fields) + ">>"
    parsed = lines.select(F.explode(F.from_json("value", f"map<string, {kind}>")).alias("userkey", "rec"), "dt")
    return parsed.select(empty_if_null(F.col("userkey")).alias("userkey"),
                         F.coalesce("rec", F.array().cast(kind)).alias("rec"), "dt")


def list_records(lines: DataFrame) -> DataFrame:
    """``{user: {list, ...}}`` -> one row with an array per list; nulls become empty."""
    kind = "struct<" + ", ".join(f"{f}: array<{t}>" for f, t in APP_ACCESS) + ", hitDictLevel: string>"
    parsed = lines.select(F.explode(F.from_json("value", f"map<string, {kind}>")).alias("user_name", "body"))
    return parsed.select(empty_if_null(F.col("user_name")).alias("user_name"),
                         *[empty_list_if_null(F.col(f"body.{f}"), t).alias(f) for f, t in APP_ACCESS],
                         empty_if_null(F.col("body.hitDictLevel")).alias("hitDictLevel"))
