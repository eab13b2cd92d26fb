"""Declared schemas of the planning tables. Codes are strings and are never inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from ..functions.numeric import MONEY

_TYPES: dict[str, DataType] = {
    "str": StringType(),
    "date": DateType(),
    "int": IntegerType(),
    "long": LongType(),
    "dbl": DoubleType(),
    "money": MONEY,
    "bool": BooleanType(),
}


def _schema(spec: str) -> StructType:
    fields = (item.split(":") for item in spec.split())
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields])


ENTITIES = _schema("company_code:str entity_name:str region:str currency:str")
SEGMENTS = _schema("profit_center:str segment_name:str segment_type:str")
COST_CENTERS = _schema("cost_center:str department:str function:str")
GL_ACCOUNTS = _schema(
    "gl_account:str account_name:str account_group:str pnl_category:str normal_balance:str"
)
CALENDAR = _schema(
    "period:date fiscal_year:int fiscal_quarter:str month_name:str is_actual:bool"
)
SCENARIOS = _schema(
    "scenario:str rev_growth_delta:dbl churn_delta:dbl opex_growth_delta:dbl description:str"
)
REVENUE = _schema(
    "period:date profit_center:str company_code:str gl_account:str customers:dbl arpu:dbl "
    "revenue:money new_logos:dbl churned_customers:dbl"
)
HEADCOUNT = _schema(
    "period:date cost_center:str company_code:str headcount:dbl avg_fully_loaded_cost:dbl"
)
OPEX = _schema("period:date cost_center:str company_code:str gl_account:str amount:money")
GL = _schema(
    "document_number:long posting_date:date period:date company_code:str profit_center:str "
    "cost_center:str gl_account:str amount:money debit_credit:str document_type:str source:str"
)
BUDGET = _schema(
    "period:date dim1:str dim2:str gl_account:str line_type:str budget_amount:money"
)
FORECAST = _schema(
    "period:date dim1:str dim2:str gl_account:str line_type:str forecast_amount:money"
)
LRP = _schema(
    "fiscal_year:int plan_revenue:dbl plan_opex:dbl plan_ebitda:dbl plan_ebitda_margin:dbl"
)
COMMENTARY = _schema(
    "fiscal_quarter:str cost_center:str commentary_text:str authored_tone_label:str"
)
POSTINGS = _schema(
    "period:date line_type:str dim1:str dim2:str gl_account:str amount:money"
)
