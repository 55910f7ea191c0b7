"""Fields of an event kept as a VARIANT, with the JSON type still visible."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numeric text as accepted by the input rules. Spark's cast would also take Java's "12.5d".
NUMERAL = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def field(event: Column, name: str) -> Column:
    """The field as a VARIANT. A JSON null is a non-NULL VARIANT, so NULL means the field is absent."""
    return F.try_variant_get(event, f"$.{name}", "variant")


def as_text(value: Column) -> Column:
    """A field where it is a JSON string, else NULL: 7 is not "7"."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def as_number(value: Column, text: Column) -> Column:
    """A field as a double, from a JSON number, boolean or numeric text, else NULL; ``text`` is the field as text."""
    return F.when(text.isNull() | text.rlike(NUMERAL), F.try_variant_get(value, "$", "double"))
