"""The customer profile, on master tables derived from the star schema."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from entityloom.operators.entities import KEY
from entityloom.plans.customer_job import CustomerJob
from entityloom.plans.customer_profile import customer_profile, customer_rules
from entityloom.plans.order_profile import code_table
from entityloom.plans.registry import query
from entityloom.sources.entity_rows import PARQUET_CLIENT, ClientSource
from entityloom.sources.shared import new_path
from entityloom.sources.tables import land
from entityloom.together import together

ID_WIDTH = 12

# The code table derived from a large table; Spark cannot tell that it is small.
DERIVED = ["credit_risk_lang"]

# Code tables that are fixed lists.
CODE_TABLES = {
    "tax_exemption_type_lang": """
        select * from values
          ('1', 'URGENT', 'en'), ('2', 'HIGH', 'en'), ('3', 'MEDIUM', 'en'),
          ('4', 'NOT SPECIFIED', 'en'), ('5', 'LOW', 'en'),
          ('1', 'FR URGENT', 'fr'), ('2', 'FR HIGH', 'fr')
        as t(tax_exemption_code, tax_exemption_desc, language_type_code)
    """,
    "customer_status_lang": """
        select * from values
          ('A', 'automobile', 'en'), ('B', 'building', 'en'), ('F', 'furniture', 'en'),
          ('H', 'household', 'en'), ('M', 'machinery', 'en'), ('M', 'machines', 'fr')
        as t(customer_status_code, display_short_desc, language_type_code)
    """,
    "new_sales_type_lang": """
        select * from values
          ('F', 'sale F', 'en'), ('O', 'sale O', 'en'), ('P', 'sale P', 'en')
        as t(new_sales_code, new_sales_desc, language_type_code)
    """,
}


def customer_id(column: str):
    return F.lpad(F.col(column).cast("string"), ID_WIDTH, "0")


def master_tables(t) -> dict:
    """The ten tables of the profile.  Debtors have no status date and no limit;
    tax rows repeat per customer; tax codes 1 and 2 are described in two languages, and risk code
    S has two descriptions in one language."""
    spark = t["customer"].sparkSession
    nation = F.col("c_nationkey")
    debtor = F.col("c_acctbal") < 0
    segment_letter = F.substring("c_mktsegment", 1, 1)
    customers = t["customer"].select(
        customer_id("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        segment_letter.alias("customer_status_code"),
        F.when(~debtor, F.date_add(F.lit("2000-01-01").cast("date"), nation)).alias(
            "customer_status_date"
        ),
        nation.cast("string").alias("customer_store_nbr"),
        F.when(debtor, "Y").otherwise("N").alias("non_profit_ind"),
        F.when(debtor, "N").otherwise("Y").alias("accept_orders_ind"),
        nation.cast("string").alias("credit_terms_code"),
        F.substring("c_mktsegment", 2, 1).alias("new_sales_code"),
        F.when(~debtor, nation.cast("string")).alias("new_cust_ovrd_code"),
        nation.alias("company_nbr"),
        F.date_add(F.lit("1990-01-01").cast("date"), nation * 31).alias("first_sale_date"),
        F.concat(F.lit("M"), segment_letter).alias("cust_reln_mgr_id"),
        F.date_sub(F.lit("1990-01-01").cast("date"), nation).alias("customer_add_date"),
        F.when(~debtor, F.col("c_acctbal").cast("decimal(11,2)")).alias(
            "credit_limit_dollar_amt"
        ),
        F.col("c_mktsegment").alias("business_unit_code"),
        nation.cast("smallint").alias("source_create_system_code"),
        nation.alias("primary_ship_dc_nbr"),
        F.translate(segment_letter, "B", "S").alias("credit_risk_code"),
    )

    def language_table(table, code, code_column, text_column, text, language="en"):
        return table.select(
            code.alias(code_column),
            text.alias(text_column),
            F.lit(language).alias("language_type_code"),
        )

    nation_code = F.col("n_nationkey").cast("string")
    return {
        "cust_unit": customers,
        "cust_unit_tax": t["orders"].select(
            customer_id("o_custkey").alias("customer_id"),
            F.substring("o_orderpriority", 1, 1).alias("tax_exemption_code"),
            F.col("o_orderkey").cast("string").alias("sales_tax_exempt_id"),
        ),
        **{name: spark.sql(text) for name, text in CODE_TABLES.items()},
        "credit_terms_lang": language_table(
            t["nation"], nation_code, "credit_terms_code", "credit_terms_desc", F.col("n_name")
        ),
        "new_cust_ovrd_type_lang": language_table(
            t["region"],
            F.col("r_regionkey").cast("string"),
            "new_cust_ovrd_code",
            "new_cust_ovrd_desc",
            F.col("r_name"),
        ),
        "cust_codes_language_desc": code_table(t),
        "credit_risk_lang": language_table(
            t["part"].select("p_type").distinct(),
            F.substring("p_type", 1, 1),
            "credit_risk_code",
            "credit_risk_desc",
            F.col("p_type"),
        ),
        "customer_segment_asgn": t["labels"].select(
            customer_id("doc_id").alias("customer_id"),
            F.col("toxic").cast("string").alias("customer_type_code"),
            F.col("quality").cast("smallint").alias("customer_segment_code"),
        ),
    }


PROFILE_SQL = """
    select lpad(cast(c_custkey as varchar), 12, '0') as customer_id,
           c_name as customer_name,
           c_mktsegment[1] as customer_status_code,
           lower(c_mktsegment) as customer_status_desc,
           case when c_acctbal >= 0 then
             strftime(date '2000-01-01' + c_nationkey, '%Y-%m-%d') end as customer_status_date,
           cast(c_nationkey as varchar) as customer_store_nbr,
           case when c_acctbal < 0 then 'Y' else 'N' end as non_profit_indicator,
           case when c_acctbal < 0 then 'N' else 'Y' end as accept_orders_indicator,
           cast(c_nationkey as varchar) as credit_terms_code,
           terms.n_name as credit_terms_desc,
           cast(o_orderkey as varchar) as sales_tax_exempt_id,
           c_mktsegment[2] as new_sales_code,
           case when c_mktsegment[2] in (select o_orderstatus from orders)
             then 'sale ' || c_mktsegment[2] end as new_sales_desc,
           case when c_acctbal >= 0 then cast(c_nationkey as varchar) end
             as new_cust_override_code,
           case when c_acctbal >= 0 then ovr.r_name end as new_cust_override_desc,
           c_nationkey as company_nbr,
           strftime(date '1990-01-01' + c_nationkey * 31, '%Y-%m-%d') as first_sale_date,
           o_orderpriority[1] as tax_exemption_code,
           case lang.code when 'fr' then 'FR ' else '' end || o_orderpriority[3:]
             as tax_exemption_desc,
           'M' || c_mktsegment[1] as cust_reln_mgr_id,
           strftime(date '1990-01-01' - c_nationkey, '%Y-%m-%d') as customer_added_date,
           case when c_acctbal < 0 then 0
             else cast(cast(c_acctbal as decimal(11,2)) as double) end
             as credit_limit_dollar_amt,
           c_mktsegment as customer_division_id,
           cast(c_nationkey as smallint) as source_system_code,
           case when terms.n_regionkey < 4 then terms.n_name end as source_system_desc,
           c_nationkey as primary_ship_dc_nbr,
           translate(c_mktsegment[1], 'B', 'S') as credit_risk_code,
           risk.descr as credit_risk_desc,
           case when toxic = 0 then cast(quality as smallint) end as customer_segment_code,
           case when toxic = 0 then seg.r_name end as customer_segment_desc
    from customer
    left join nation terms on terms.n_nationkey = c_nationkey
    left join region ovr on ovr.r_regionkey = c_nationkey
    left join orders on o_custkey = c_custkey
    left join (values ('en'), ('fr')) lang(code)
      on lang.code = 'en' and o_orderkey is not null
      or lang.code = 'fr' and o_orderpriority < '3'
    left join (select distinct p_type[1] as code, p_type as descr from part) risk
      on risk.code = translate(c_mktsegment[1], 'B', 'S')
    left join labels on doc_id = c_custkey
    left join region seg on seg.r_regionkey = quality
"""


@query(PROFILE_SQL, name="customer_profile")
def profile_rows(t):
    rows = customer_profile(measure=DERIVED).rows(master_tables(t))
    amount = F.col("credit_limit_dollar_amt").cast("double")
    return rows.withColumn("credit_limit_dollar_amt", amount)


@query(PROFILE_SQL)
def customer_profile_client(t):
    """The customer job's rows, its ten tables read through a client of one's own."""
    spark = t["customer"].sparkSession
    folder, tables = new_path(spark, "master-tables"), master_tables(t)
    together(spark, *[partial(land, df, name, folder) for name, df in tables.items()])
    schemas = {
        name: ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes) for name, df in tables.items()
    }
    source = ClientSource(PARQUET_CLIENT, schemas, {"folder": folder})
    rows = CustomerJob("demo", measure=DERIVED).rows(spark, source)
    amount = F.col("credit_limit_dollar_amt").cast("double")
    return rows.withColumn("credit_limit_dollar_amt", amount)


@query(f"select * from ({PROFILE_SQL}) where customer_id = '000000000042'")
def customer_profile_one(t):
    rows = customer_profile(measure=DERIVED).rows(master_tables(t), only="000000000042")
    amount = F.col("credit_limit_dollar_amt").cast("double")
    return rows.withColumn("credit_limit_dollar_amt", amount)


# How the first row of a customer is chosen, as the customer rules do.
FIRST_ROW = """
    row_number() over (partition by customer_id order by
      sales_tax_exempt_id nulls last, tax_exemption_code nulls last,
      tax_exemption_desc nulls last, customer_segment_code nulls last,
      customer_segment_desc nulls last, credit_risk_desc nulls last)
"""


@query(
    f"""
    select * exclude (first_row, company_nbr, source_system_code, primary_ship_dc_nbr,
                      customer_segment_code),
           'demo' as project, 'Customer' as kind, customer_id as key_name,
           cast(company_nbr as bigint) as company_nbr,
           cast(source_system_code as bigint) as source_system_code,
           cast(primary_ship_dc_nbr as bigint) as primary_ship_dc_nbr,
           cast(customer_segment_code as bigint) as customer_segment_code
    from (select *, {FIRST_ROW} as first_row from ({PROFILE_SQL}))
    where first_row = 1
    """
)
def customer_entities(t):
    rules = customer_rules("demo")
    keyed = rules.keyed(customer_profile(measure=DERIVED).rows(master_tables(t)))
    return rules.entities(keyed).select(
        F.col(f"{KEY}.project").alias("project"),
        F.col(f"{KEY}.kind").alias("kind"),
        F.col(f"{KEY}.name").alias("key_name"),
        *[c for c in keyed.columns if c != KEY],
    )
