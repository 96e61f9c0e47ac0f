"""Table schemas, value domains and rule settings.

Every read states its schema, so nothing is inferred from data and timestamps
stay zone-less (``TimestampNTZType``) from the source to the gold tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

# The domains of the three coded columns, and the declared maximum
# length of each text column. They must equal the source system's.
RISK_TIERS = ("LOW", "MEDIUM", "HIGH", "PEP")
PAYMENT_CHANNELS = ("SEPA", "INSTANT_SEPA", "CARD")
STATUSES = ("PENDING", "SETTLED", "BLOCKED")
CURRENCIES = ("EUR",)
HOME_COUNTRY = "FR"
DEFAULT_STATUS = "PENDING"
CUSTOMER_LENGTHS = {
    "customer_id": 36,
    "first_name": 100,
    "last_name": 100,
    "email": 255,
    "phone_number": 30,
    "iban": 34,
    "address": 500,
    "city": 100,
    "country": 5,
    "risk_tier": 10,
}
TRANSACTION_LENGTHS = {
    "transaction_id": 36,
    "sender_iban": 34,
    "beneficiary_iban": 34,
    "amount": 20,
    "currency": 3,
    "payment_channel": 20,
    "status": 10,
    "blocked_reason": 255,
}
CUSTOMER_REQUIRED = ("customer_id", "first_name", "last_name", "iban", "risk_tier", "created_at")
TRANSACTION_REQUIRED = (
    "transaction_id",
    "sender_iban",
    "beneficiary_iban",
    "amount",
    "currency",
    "payment_channel",
    "status",
    "executed_at",
)

AMOUNT = T.DecimalType(18, 2)
ROLLING_AMOUNT = T.DecimalType(28, 2)


def _struct(texts: list[str], times: list[str]) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in texts]
    return T.StructType(fields + [T.StructField(name, T.TimestampNTZType()) for name in times])


CUSTOMERS = _struct(list(CUSTOMER_LENGTHS), ["created_at"])
TRANSACTIONS = _struct(list(TRANSACTION_LENGTHS), ["executed_at"])
# On the wire the event time is ISO-8601 text, so that a bad one can be quarantined.
TRANSACTION_EVENT = _struct([*TRANSACTION_LENGTHS, "executed_at"], [])
BLOCK_DECISIONS = _struct(["transaction_id", "blocked_reason"], ["decided_at"])

CUSTOMER_COLUMNS = CUSTOMERS.fieldNames()
TRANSACTION_COLUMNS = TRANSACTIONS.fieldNames()


# The defaults of the two rules and the code an alert carries.
@dataclass(frozen=True)
class VelocityRule:
    """Block a transfer when it is the n-th of its sender within the window.

    The window is open on the left: a transfer exactly ``window_minutes`` old no
    longer counts.
    """

    max_transactions: int = 5
    window_minutes: int = 60
    channels: tuple[str, ...] = ("INSTANT_SEPA",)
    risk_tiers: tuple[str, ...] = ("HIGH", "PEP")


@dataclass(frozen=True)
class CrossBorderRule:
    """Alert when the rolling cross-border sum of a sender is above the threshold.

    The window is closed on both sides.
    """

    days: int = 30
    threshold: Decimal = Decimal("10000")
    code: str = "CUMULATIVE_CROSS_BORDER_10K"
