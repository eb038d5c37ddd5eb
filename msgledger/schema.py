"""Record schemas declared as a small spec and turned into Spark types."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

MONEY = T.DecimalType(18, 2)

_TYPES: dict[str, T.DataType] = {"str": T.StringType(), "number": MONEY, "date": T.DateType()}

# The ledger record, in column order. ``nullable`` says whether a required
# field may be present with a null value.
TRANSACTIONS: dict[str, dict] = {
    "date": {"type": "date", "required": True, "nullable": True},
    "internal_account_number": {"type": "str", "required": True, "nullable": False},
    "internal_entity": {"type": "str", "required": True, "nullable": False},
    "institution": {"type": "str", "required": True, "nullable": False},
    "external_entity": {"type": "str", "required": False, "nullable": True},
    "amount": {"type": "number", "required": True, "nullable": True},
    "available_balance": {"type": "number", "required": False, "nullable": True},
    "currency": {"type": "str", "required": True, "nullable": True},
    "description": {"type": "str", "required": True, "nullable": False},
    "transaction_type": {"type": "str", "required": True, "nullable": False},
    "source_email": {"type": "str", "required": True, "nullable": True},
    "message_id": {"type": "str", "required": True, "nullable": True},
    "run_id": {"type": "str", "required": True, "nullable": False},
}


def build_schema(spec: Mapping[str, Mapping]) -> T.StructType:
    """Spec -> StructType; ``required`` and ``nullable`` travel as column metadata."""
    return T.StructType([
        T.StructField(
            name,
            _TYPES[cfg["type"]],
            True,
            {"required": bool(cfg.get("required", False)), "nullable": bool(cfg.get("nullable", True))},
        )
        for name, cfg in spec.items()
    ])


RECORD = build_schema(TRANSACTIONS)


def raw_schema(spec: Mapping[str, Mapping] = TRANSACTIONS) -> T.StructType:
    """The same fields before coercion: all strings."""
    return T.StructType([T.StructField(name, T.StringType()) for name in spec])


def project_to(df: DataFrame, schema: T.StructType = RECORD) -> DataFrame:
    """Keep the schema's columns in its order and types; extra ones go, missing ones are null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def string_fields(schema: T.StructType = RECORD) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
