"""Time steps and date ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the first mission's start.
MISSION_START = "1972-07-23"


def add_units(date: Column, unit: str, n) -> Column:
    return F.add_months(date, n) if unit == "months" else F.date_add(date, n * (7 if unit == "weeks" else 1))


def time_steps(items: DataFrame, unit: str, n: int) -> DataFrame:
    """items(start, end) with step_no, step_start and step_end of the whole steps that fit, however many there are.
    Steps advance by repeated addition, so month ends drift: Jan 31, Feb 28, Mar 28. Ends are a chain of their own from
    start + n. An end before the start gives no step."""
    if unit == "all":
        return items.withColumns({"step_no": F.lit(0), "step_start": F.col("start"), "step_end": F.col("end")})
    count = F.greatest(F.lit(0), F.ceil(F.datediff("end", "start") / ({"days": 1, "weeks": 7, "months": 28}[unit] * n)).cast("int") + 1)
    if unit != "months":
        out = items.select("*", F.explode(F.sequence(F.lit(0), count)).alias("step_no")).withColumns({"step_start": add_units(F.col("start"), unit, F.col("step_no") * n), "step_end": F.date_sub(add_units(F.col("start"), unit, (F.col("step_no") + 1) * n), 1)})
        return out.where("step_end <= `end`")
    chain = lambda first: F.aggregate(
        F.sequence(F.lit(0), count), F.struct(first.alias("at"), F.array().cast("array<date>").alias("out")),
        lambda acc, _: F.struct(add_units(acc["at"], unit, n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"],
    )
    pairs = F.arrays_zip(chain(F.col("start")).alias("s"), chain(add_units(F.col("start"), unit, n)).alias("e"))
    out = items.select("*", F.posexplode(pairs).alias("step_no", "_p")).where(F.date_sub("_p.e", 1) <= F.col("end"))
    return out.select(*items.columns, "step_no", F.col("_p.s").alias("step_start"), F.date_sub("_p.e", 1).alias("step_end"))


def default_start(end: Column) -> Column:
    return F.coalesce(F.date_sub(end, 31), F.lit(MISSION_START).cast("date"))


def dynamic_range(date: Column, unit: str, n: int) -> Column:
    return F.struct(add_units(date, unit, -n).alias("start"), date.alias("end"))


def date_from_path(path: Column) -> Column:
    return F.to_date(F.nullif(F.regexp_extract(path, r"(\d{4}_\d{2}_\d{2})\.tif$", 1), F.lit("")), "yyyy_MM_dd")
