"""The checks that are declared for each table."""

from __future__ import annotations

from ledgerwatch.operators.marts import ROLLING
from ledgerwatch.operators.quality import (
    accepted,
    between,
    length_is,
    max_length,
    not_null,
    row_count,
    unique,
)
from ledgerwatch.schemas import (
    CURRENCIES,
    CUSTOMER_LENGTHS,
    CUSTOMER_REQUIRED,
    PAYMENT_CHANNELS,
    RISK_TIERS,
    STATUSES,
    TRANSACTION_LENGTHS,
    TRANSACTION_REQUIRED,
    CrossBorderRule,
)

SOURCE_CUSTOMERS = [
    unique("customer_id"),
    unique("iban"),
    *(not_null(name) for name in CUSTOMER_REQUIRED),
    *(max_length(name, length) for name, length in CUSTOMER_LENGTHS.items()),
]
SOURCE_TRANSACTIONS = [
    unique("transaction_id"),
    *(not_null(name) for name in TRANSACTION_REQUIRED),
    *(max_length(name, length) for name, length in TRANSACTION_LENGTHS.items()),
]
STG_TRANSACTIONS = [
    unique("transaction_id"),
    not_null("transaction_id"),
    not_null("sender_iban_hmac"),
    length_is("sender_iban_hmac", 64),
    not_null("amount_eur"),
    between("amount_eur", low=0),
    accepted("status", STATUSES),
]
STG_CUSTOMERS = [
    row_count(low=1),
    unique("customer_id"),
    not_null("customer_id"),
    unique("iban_hmac"),
    not_null("iban_hmac"),
    accepted("risk_tier", RISK_TIERS),
]
FCT_TRANSACTIONS = [
    unique("transaction_id"),
    not_null("transaction_id"),
    not_null("amount_eur"),
    not_null("final_status"),
    accepted("final_status", STATUSES),
    accepted("payment_channel", PAYMENT_CHANNELS),
    accepted("currency", CURRENCIES),
]
AML_ALERTS = [
    not_null("transaction_id"),
    not_null("rule_code"),
    accepted("rule_code", [CrossBorderRule().code]),
    not_null(ROLLING),
    between(ROLLING, low=CrossBorderRule().threshold),
]
