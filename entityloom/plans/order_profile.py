"""A profile of orders on the star-schema tables, with every kind of lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.functions.scalars import iso_date, or_zero
from entityloom.operators.lookups import Lookup
from entityloom.plans.entity_job import Profile

NATION_LIST, REGION_LIST, BRAND_LIST = 33, 1, 99


def code_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One table of several code lists: nations, regions, and brands, whose codes
    are not numeric.  Some nations are described in French only."""

    def codes(list_id: int, code: str, text: Column, language: Column) -> list[Column]:
        return [
            F.lit(list_id).alias("code_table_ref_id"),
            F.col(code).cast("string").alias("code_value"),
            text.alias("code_desc"),
            language.alias("language_type_code"),
        ]

    english, french = F.lit("en"), F.lit("fr")
    nation, name = tables["nation"], F.col("n_name")
    described = F.when(F.col("n_regionkey") < 4, english).otherwise(french)
    return (
        nation.select(*codes(NATION_LIST, "n_nationkey", name, described))
        .unionByName(
            nation.where("n_regionkey < 4").select(
                *codes(NATION_LIST, "n_nationkey", F.concat(F.lit("FR_"), name), french)
            )
        )
        .unionByName(
            tables["region"].select(
                *codes(REGION_LIST, "r_regionkey", F.col("r_name"), english)
            )
        )
        .unionByName(
            tables["part"]
            .select(*codes(BRAND_LIST, "p_brand", F.col("p_type"), english))
            .distinct()
        )
    )


def order_status_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["orders"].sparkSession.sql(
        "select * from values ('F', 'finished', 'en'), ('O', 'open', 'en'),"
        " ('F', 'fini', 'fr') as t(status_code, status_desc, language_type_code)"
    )


def with_code_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        **{name: tables[name] for name in ("orders", "customer", "nation", "lineitem")},
        "codes": code_table(tables),
        "order_status": order_status_table(tables),
    }


def numeric_code(list_id: int, key: str, description: str) -> Lookup:
    return Lookup(
        "codes",
        on={"code_value": key},
        where={"code_table_ref_id": list_id, "language_type_code": "en"},
        take={description: "code_desc"},
        code_type="smallint",
    )


def order_profile() -> Profile:
    """The large tables come first, so that no description is shuffled."""
    lookups = [
        Lookup(
            "lineitem",
            on={"l_orderkey": "o_orderkey"},
            where={"l_linenumber": 1},
            take={"first_line_price": "l_extendedprice"},
            satellite=True,
        ),
        Lookup(
            "customer",
            on={"c_custkey": "o_custkey"},
            where={"c_mktsegment": "BUILDING"},
            take={"customer_name": "c_name", "nation_key": "c_nationkey"},
        ),
        Lookup(
            "nation",
            on={"n_nationkey": "nation_key"},
            take={"nation_name": "n_name", "region_key": "n_regionkey"},
        ),
        numeric_code(NATION_LIST, "nation_key", "nation_desc"),
        numeric_code(REGION_LIST, "region_key", "region_desc"),
        Lookup(
            "order_status",
            on={"status_code": "o_orderstatus"},
            where={"language_type_code": "en"},
            take={"order_status_desc": "status_desc"},
        ),
    ]

    def output():
        return [
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_orderstatus").alias("order_status_code"),
            F.col("order_status_desc"),
            iso_date(F.col("o_orderdate")).alias("order_date"),
            or_zero(F.col("first_line_price")).alias("first_line_amount"),
            F.col("customer_name"),
            F.col("nation_name"),
            F.col("nation_desc"),
            F.col("region_desc"),
        ]

    return Profile(
        "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"],
        lookups,
        output,
        filter_column="o_custkey",
    )
