"""Column expressions. Everything here stays on the JVM; there are no UDFs."""

from levyflow.functions.numbers import clean_number, malformed, net_amount, to_integer, to_money
from levyflow.functions.scaling import scale, two_way_label, unscale

__all__ = [
    "clean_number",
    "malformed",
    "net_amount",
    "scale",
    "to_integer",
    "to_money",
    "two_way_label",
    "unscale",
]
