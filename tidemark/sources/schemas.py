"""Schemas of the raw extracts; nothing is inferred."""

from pyspark.sql import types as T


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


_TEXT, _REAL, _DAY = T.StringType(), T.DoubleType(), T.DateType()

PROJECTS = T.StructType(
    _fields(_TEXT, "project_id", "project_name", "department", "status")
    + _fields(_DAY, "start_date", "end_date")
    + _fields(_REAL, "budget", "actual_cost")
    + _fields(_TEXT, "project_manager_id", "priority", "region")
)

# Dirty extract: every column stays text until it is cleaned.
EMPLOYEES = T.StructType(
    _fields(
        _TEXT, "employee_id", "full_name", "email", "department", "role", "level", "hire_date",
        "salary", "manager_id", "region", "status", "years_experience",
    )
)

SALARY_HISTORY = T.StructType(
    _fields(_TEXT, "employee_id")
    + _fields(_DAY, "effective_date")
    + _fields(_REAL, "previous_salary", "new_salary")
    + _fields(
        _TEXT, "previous_role", "new_role", "previous_level", "new_level", "change_type", "change_reason",
    )
)

TRANSACTIONS = T.StructType(
    _fields(_TEXT, "transaction_id", "project_id", "vendor_id", "vendor_name", "category")
    + _fields(_REAL, "amount")
    + _fields(_TEXT, "currency", "transaction_date", "approved_by", "payment_status", "invoice_ref", "notes")
)

EVENTS = T.StructType(
    _fields(_TEXT, "event_id", "event_type", "project_id", "user_id")
    + _fields(T.TimestampType(), "timestamp")
    + [T.StructField("payload", T.MapType(_TEXT, _TEXT))]
)
