"""Contact-table schema and column roles."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, StringType, StructType

# Column names and types of the contact table, in file order.
CONTACT_COLUMNS = {
    "age": "int", "job": "string", "marital": "string", "education": "string",
    "default": "string", "balance": "int", "housing": "string", "loan": "string",
    "contact": "string", "day": "int", "month": "string", "duration": "int",
    "campaign": "int", "pdays": "int", "previous": "int", "poutcome": "string",
    "y": "string",
}
# Column roles.
CATEGORICAL = [
    "job", "marital", "education", "default", "housing", "loan", "contact",
    "month", "poutcome",
]
NUMERIC = ["age", "balance", "day", "duration", "campaign", "pdays", "previous"]
TARGET = "y"
POSITIVE = "yes"
# Month names as the table spells them, in calendar order.
MONTHS = [
    "jan", "feb", "mar", "apr", "may", "jun",
    "jul", "aug", "sep", "oct", "nov", "dec",
]


def schema_of(columns: dict[str, str]) -> StructType:
    """An all-nullable schema from column names and type names."""
    types = {"int": IntegerType(), "string": StringType()}
    schema = StructType()
    for name, kind in columns.items():
        schema.add(name, types[kind])
    return schema


CONTACT_SCHEMA = schema_of(CONTACT_COLUMNS)
