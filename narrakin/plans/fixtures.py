"""Company master and narrations derived from the customer and orders tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.session import spread_scan

# Word pools of the derived company names.
NAMES = ("KUMARAN GANESH INDIRA RAMCO LAKSHMI SUNDAR BHARAT OMEGA VIJAY MERCURY ANAND PRIYA DEEPAK "
         "NOVA SURYA ROYAL MODERN STAR GOLDEN UNITED").split()
TRADES = ("HARDWARE AGENCIES SYSTEMS TRADERS MOTORS TEXTILES PHARMACY STEELS FOODS EXPORTS PAPERS "
          "PLASTICS").split()
LEGAL = ["", "PVT LTD", "LIMITED", "& CO", "INC"]
CITIES = ("CHENNAI MUMBAI DELHI PUNE KOLKATA SURAT JAIPUR LUCKNOW NAGPUR MADURAI SALEM VELLORE ERODE "
          "TIRUPUR KUMBAKOT COIMBATORE").split()
CHANNELS = ["NEFT", "RTGS", "IMPS", "UPI", "PAID TO"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(pool: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, pool)), (index + 1).cast("int"))


def _name_parts(k: Column) -> dict[str, Column]:
    letters = F.concat(*[F.char(65 + F.floor(k / d) % 26) for d in (1, 26, 676)])
    return {
        "name": _pick(NAMES, k % len(NAMES)),
        "letters": letters,
        "trade": _pick(TRADES, F.floor(k / 20) % len(TRADES)),
        "legal": _pick(LEGAL, k % len(LEGAL)),
        "city": _pick(CITIES, F.floor(k / 7) % len(CITIES)),
    }


def company_name(k: Column, *parts: str) -> Column:
    have = _name_parts(k)
    chosen = parts or ("name", "letters", "trade", "legal", "city")
    return F.trim(F.regexp_replace(F.concat_ws(" ", *[have[p] for p in chosen]), " +", " "))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return spread_scan(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select(
        k.alias("company_id"), company_name(k).alias("company_name"))


def narrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = F.col("o_orderkey"), F.col("o_custkey")
    full = company_name(k)
    kind = n % 8
    body = (
        F.when(kind == 1, company_name(k, "name", "letters", "trade", "city"))
        .when(kind == 2, company_name(k, "name", "letters", "city"))
        .when(kind == 3, F.concat(full, F.lit(" HDFC BANK")))
        .when(kind == 4, F.concat(full, F.lit(" STATE BANK OF INDIA")))
        .when(kind == 5, F.array_join(F.reverse(F.split(full, " ")), " "))
        .when(kind == 6, F.concat(full, F.lit(" A****885 12-05-2024")))
        .when(kind == 7, F.upper(F.substring(F.md5(F.concat(F.lit("x"), n.cast("string"))), 1, 6)))
        .otherwise(full)
    )
    code = F.upper(F.substring(F.md5(n.cast("string")), 1, 14))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return spread_scan(orders, "o_orderkey").select(
        n.alias("txn_id"), k.alias("true_company_id"), F.col("o_orderdate").alias("txn_date"),
        F.col("o_totalprice").alias("amount"),
        F.concat_ws("/", _pick(CHANNELS, n % 5), code, body).alias("narration"))
