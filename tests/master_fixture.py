"""The ten master tables with the rows that tell right from wrong (invented values)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

DAY = dt.date(2020, 2, 29)

SCHEMAS = {
    "cust_unit": (
        "customer_id string, customer_name string, customer_status_code string,"
        " customer_status_date date, customer_store_nbr string, non_profit_ind string,"
        " accept_orders_ind string, credit_terms_code string, new_sales_code string,"
        " new_cust_ovrd_code string, company_nbr int, first_sale_date date,"
        " cust_reln_mgr_id string, customer_add_date date,"
        " credit_limit_dollar_amt decimal(11,2), business_unit_code string,"
        " source_create_system_code smallint, primary_ship_dc_nbr int,"
        " credit_risk_code string"
    ),
    "cust_unit_tax": (
        "customer_id string, tax_exemption_code string, sales_tax_exempt_id string"
    ),
    "tax_exemption_type_lang": (
        "tax_exemption_code string, tax_exemption_desc string, language_type_code string"
    ),
    "customer_status_lang": (
        "customer_status_code string, display_short_desc string, language_type_code string"
    ),
    "credit_terms_lang": (
        "credit_terms_code string, credit_terms_desc string, language_type_code string"
    ),
    "new_cust_ovrd_type_lang": (
        "new_cust_ovrd_code string, new_cust_ovrd_desc string, language_type_code string"
    ),
    "new_sales_type_lang": (
        "new_sales_code string, new_sales_desc string, language_type_code string"
    ),
    "cust_codes_language_desc": (
        "code_table_ref_id int, code_value string, code_desc string,"
        " language_type_code string"
    ),
    "credit_risk_lang": (
        "credit_risk_code string, credit_risk_desc string, language_type_code string"
    ),
    "customer_segment_asgn": (
        "customer_id string, customer_type_code string, customer_segment_code smallint"
    ),
}


def customer(customer_id, name, **changes):
    row = {
        "customer_id": customer_id,
        "customer_name": name,
        "customer_status_code": "A",
        "customer_status_date": DAY,
        "customer_store_nbr": "S1",
        "non_profit_ind": "N",
        "accept_orders_ind": "Y",
        "credit_terms_code": "T1",
        "new_sales_code": "N1",
        "new_cust_ovrd_code": "O1",
        "company_nbr": 10,
        "first_sale_date": dt.date(2019, 1, 2),
        "cust_reln_mgr_id": "M1",
        "customer_add_date": dt.date(1999, 12, 31),
        "credit_limit_dollar_amt": Decimal("2500.50"),
        "business_unit_code": "B1",
        "source_create_system_code": 7,
        "primary_ship_dc_nbr": 3,
        "credit_risk_code": "R1",
    }
    return tuple({**row, **changes}.values())


CODES = [
    "customer_status_code",
    "credit_terms_code",
    "new_sales_code",
    "new_cust_ovrd_code",
    "credit_risk_code",
]

ROWS = {
    "cust_unit": [
        customer("000123", "plain, leading zeros"),
        customer(
            "miss", "no lookup hits", source_create_system_code=99, **dict.fromkeys(CODES, "?")
        ),
        customer(
            "null", "null codes", source_create_system_code=None, **dict.fromkeys(CODES)
        ),
        customer("fr", "status in French only", customer_status_code="F"),
        customer("tax2", "two tax rows"),
        customer("lang2", "tax text in two languages"),
        customer("seg1", "segment of another type"),
        customer(
            "empty",
            "null dates and limit",
            customer_status_date=None,
            first_sale_date=None,
            customer_add_date=None,
            credit_limit_dollar_amt=None,
        ),
    ],
    "cust_unit_tax": [
        ("000123", "E1", "X-1"),
        ("tax2", "E1", "X-2"),
        ("tax2", "E9", "X-3"),
        ("lang2", "E2", "X-4"),
        ("other", "E1", "X-5"),
    ],
    "tax_exemption_type_lang": [
        ("E1", "school", "en"),
        ("E2", "church", "en"),
        ("E2", "eglise", "fr"),
    ],
    "customer_status_lang": [("A", "active", "en"), ("A", "actif", "fr"), ("F", "ferme", "fr")],
    "credit_terms_lang": [("T1", "30 days", "en"), ("T1", "30 jours", "fr")],
    "new_cust_ovrd_type_lang": [("O1", "override", "en")],
    "new_sales_type_lang": [("N1", "new sale", "en")],
    "cust_codes_language_desc": [
        (33, "7", "web shop", "en"),
        (33, "7", "boutique", "fr"),
        (1, "7", "segment seven", "en"),
        (1, "2", "restaurants", "en"),
        (33, "2", "branch", "en"),
        (99, "abc", "not a number", "en"),
        (99, "7", "another list", "en"),
    ],
    "credit_risk_lang": [("R1", "low", "en")],
    "customer_segment_asgn": [
        ("000123", "0", 2),
        ("000123", "1", 7),
        ("seg1", "1", 2),
        ("tax2", "0", 7),
    ],
}

# customer_id: (tax id, tax text, segment text) of each expected row
EXPECTED = {
    "000123": [("X-1", "school", "restaurants")],
    "miss": [(None, None, None)],
    "null": [(None, None, None)],
    "fr": [(None, None, None)],
    "tax2": [("X-2", "school", "segment seven"), ("X-3", None, "segment seven")],
    "lang2": [("X-4", "church", None), ("X-4", "eglise", None)],
    "seg1": [(None, None, None)],
    "empty": [(None, None, None)],
}


def frames(spark, extra=None, owner=""):
    """The tables from rows; ``extra`` adds rows, ``owner`` prefixes names."""
    return {
        _named(name, owner): _prefixed(
            spark.createDataFrame(ROWS[name] + (extra or {}).get(name, []), schema), owner
        )
        for name, schema in SCHEMAS.items()
    }


def literal_frames(spark, extra=None):
    """The tables as unions of SQL literals, which the optimiser evaluates early."""

    def text(value, type_name):
        if value is None:
            return f"cast(null as {type_name})"
        value = str(value).replace("'", "''")
        return f"cast('{value}' as {type_name})"

    out = {}
    for name, schema in SCHEMAS.items():
        columns = [c.split(" ") for c in schema.split(", ")]
        out[name] = spark.sql(
            " union all ".join(
                "select "
                + ", ".join(f"{text(v, t)} as {c}" for v, (c, t) in zip(row, columns))
                for row in ROWS[name] + (extra or {}).get(name, [])
            )
        )
    return out


def _named(name, owner):
    owned = name in ("cust_unit", "cust_unit_tax", "customer_segment_asgn")
    return owner + name if owned else name


def _prefixed(df, owner):
    for column in ("customer_id", "customer_type_code"):
        if column in df.columns:
            df = df.withColumnRenamed(column, owner + column)
    return df
