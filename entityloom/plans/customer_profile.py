"""The customer profile: thirty columns over ten tables in eleven roles."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import replace

from pyspark.sql import functions as F

from entityloom.functions.scalars import iso_date, or_zero
from entityloom.operators.collapse import Order
from entityloom.operators.lookups import Lookup
from entityloom.plans.entity_job import EntityRules, Profile

# The language the descriptions are in, the lists of the shared
# code table, the customer type of a segment.
LANGUAGE = "en"
SOURCE_SYSTEM_LIST = 33
SEGMENT_LIST = 1
SEGMENT_CUSTOMER_TYPE = "0"


def described(
    table: str, code: str, description: str, text: str, measure: Collection[str]
) -> Lookup:
    """A code's description in the profile's language."""
    return Lookup(
        table,
        on={code: code},
        where={"language_type_code": LANGUAGE},
        take={description: text},
        measure=table in measure,
    )


def shared_code(
    list_id: int, code: str, description: str, measure: Collection[str]
) -> Lookup:
    """A numeric code described in the table that all code lists share."""
    table = "cust_codes_language_desc"
    return Lookup(
        table,
        on={"code_value": code},
        where={"code_table_ref_id": list_id, "language_type_code": LANGUAGE},
        take={description: "code_desc"},
        code_type="smallint",
        measure=table in measure,
    )


def customer_profile(
    owner: str = "", measure: Collection[str] = (), trim: bool = False
) -> Profile:
    """The profile as a declaration.

    ``owner`` is the prefix that the tables of the master system and its customer
    id and type columns carry at a site.  The tax and segment tables may hold
    several rows per customer, and tax descriptions come in every language there
    is, so a customer can give several rows.  These two come first: they are joined
    on the customer id, so the rows are shuffled once and without descriptions.
    ``measure`` names the code tables whose size Spark cannot tell: views over
    large tables, or tables read over JDBC.  ``trim`` is for sites whose text columns are
    blank padded: the base's are trimmed, and keys are compared without padding.
    """
    # Fixed values from here on: the columns, lookups and output names of the profile.
    customer_id = f"{owner}customer_id"
    base_columns = [
        customer_id,
        "customer_name",
        "customer_status_code",
        "customer_status_date",
        "customer_store_nbr",
        "non_profit_ind",
        "accept_orders_ind",
        "credit_terms_code",
        "new_sales_code",
        "new_cust_ovrd_code",
        "company_nbr",
        "first_sale_date",
        "cust_reln_mgr_id",
        "customer_add_date",
        "credit_limit_dollar_amt",
        "business_unit_code",
        "source_create_system_code",
        "primary_ship_dc_nbr",
        "credit_risk_code",
    ]
    lookups = [
        Lookup(
            f"{owner}cust_unit_tax",
            on={customer_id: customer_id},
            take={
                "tax_exemption_code": "tax_exemption_code",
                "sales_tax_exempt_id": "sales_tax_exempt_id",
            },
            satellite=True,
        ),
        Lookup(
            f"{owner}customer_segment_asgn",
            on={customer_id: customer_id},
            where={f"{owner}customer_type_code": SEGMENT_CUSTOMER_TYPE},
            take={"customer_segment_code": "customer_segment_code"},
            satellite=True,
        ),
        Lookup(
            "tax_exemption_type_lang",
            on={"tax_exemption_code": "tax_exemption_code"},
            take={"tax_exemption_desc": "tax_exemption_desc"},
            measure="tax_exemption_type_lang" in measure,
        ),
        shared_code(
            SEGMENT_LIST,
            "customer_segment_code",
            "customer_segment_desc",
            measure,
        ),
        described(
            "customer_status_lang",
            "customer_status_code",
            "customer_status_desc",
            "display_short_desc",
            measure,
        ),
        described(
            "credit_terms_lang",
            "credit_terms_code",
            "credit_terms_desc",
            "credit_terms_desc",
            measure,
        ),
        described(
            "new_cust_ovrd_type_lang",
            "new_cust_ovrd_code",
            "new_cust_override_desc",
            "new_cust_ovrd_desc",
            measure,
        ),
        described(
            "new_sales_type_lang",
            "new_sales_code",
            "new_sales_desc",
            "new_sales_desc",
            measure,
        ),
        described(
            "credit_risk_lang",
            "credit_risk_code",
            "credit_risk_desc",
            "credit_risk_desc",
            measure,
        ),
        shared_code(
            SOURCE_SYSTEM_LIST,
            "source_create_system_code",
            "source_system_desc",
            measure,
        ),
    ]

    def output():
        return [
            F.col(customer_id).alias("customer_id"),
            F.col("customer_name"),
            F.col("customer_status_code"),
            F.col("customer_status_desc"),
            iso_date(F.col("customer_status_date")).alias("customer_status_date"),
            F.col("customer_store_nbr"),
            F.col("non_profit_ind").alias("non_profit_indicator"),
            F.col("accept_orders_ind").alias("accept_orders_indicator"),
            F.col("credit_terms_code"),
            F.col("credit_terms_desc"),
            F.col("sales_tax_exempt_id"),
            F.col("new_sales_code"),
            F.col("new_sales_desc"),
            F.col("new_cust_ovrd_code").alias("new_cust_override_code"),
            F.col("new_cust_override_desc"),
            F.col("company_nbr"),
            iso_date(F.col("first_sale_date")).alias("first_sale_date"),
            F.col("tax_exemption_code"),
            F.col("tax_exemption_desc"),
            F.col("cust_reln_mgr_id"),
            iso_date(F.col("customer_add_date")).alias("customer_added_date"),
            or_zero(F.col("credit_limit_dollar_amt")).alias("credit_limit_dollar_amt"),
            F.col("business_unit_code").alias("customer_division_id"),
            F.col("source_create_system_code").alias("source_system_code"),
            F.col("source_system_desc"),
            F.col("primary_ship_dc_nbr"),
            F.col("credit_risk_code"),
            F.col("credit_risk_desc"),
            F.col("customer_segment_code"),
            F.col("customer_segment_desc"),
        ]

    if trim:
        lookups = [replace(spec, trim=True) for spec in lookups]
    return Profile(
        f"{owner}cust_unit", base_columns, lookups, output, filter_column=customer_id, trim=trim
    )


def customer_rules(project: str, kind: str = "Customer") -> EntityRules:
    """Customers keyed by their id.

    Several rows of one customer differ in these columns only; the first row by
    them stands for the customer.
    """

    def order_by():
        return [
            Order(name)
            for name in (
                "sales_tax_exempt_id",
                "tax_exemption_code",
                "tax_exemption_desc",
                "customer_segment_code",
                "customer_segment_desc",
            )
        ]

    return EntityRules(["customer_id"], project, kind, order_by=order_by)
