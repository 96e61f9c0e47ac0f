from __future__ import annotations

import hashlib
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerwatch.functions import columns as fn


def values(spark, rows, expression, kind="string"):
    frame = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], f"i int, v {kind}")
    return [row[0] for row in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def test_pseudonymize_is_a_key_prefixed_sha256(spark):
    iban = "FR1420041010050500013M02606"
    found = values(spark, [iban, "FR7", None], lambda c: fn.pseudonymize_iban(c, "secret"))
    assert found[0] == hashlib.sha256(b"secret" + iban.encode()).hexdigest()
    assert len(found[1]) == 64
    assert found[2] is None


def test_truncate_keeps_both_ends(spark):
    found = values(spark, ["FR1420041010050500013M02606", "FR7", None], fn.truncate_iban)
    assert found == ["FR14****2606", "FR7****FR7", None]


def test_parse_amount(spark):
    texts = ["12,50", "1.234,56", "1234.56", "1.234,567", "1.234.567,00", "-3,10", "abc", None]
    found = values(spark, texts, lambda c: fn.parse_eu_amount(c, strict=False))
    assert found == [
        Decimal("12.50"),
        Decimal("1234.56"),
        Decimal("123456.00"),
        Decimal("1234.57"),
        Decimal("1234567.00"),
        Decimal("-3.10"),
        None,
        None,
    ]


def test_strict_parse_fails_on_bad_text(spark):
    with pytest.raises(PySparkException):
        values(spark, ["abc"], fn.parse_eu_amount)


def test_format_amount_round_trip(spark):
    texts = ["12,50", "0,00", "1234,56"]
    assert values(spark, texts, lambda c: fn.format_eu_amount(fn.parse_eu_amount(c))) == texts


def test_cross_border_looks_at_the_country_code_only(spark):
    found = values(spark, ["FR76", "DE89", "fr76", None], fn.is_cross_border)
    assert found == [False, True, True, None]


def test_velocity_reason(spark):
    found = values(spark, ["PEP"], lambda c: fn.velocity_reason(F.lit(7).cast("bigint"), 60, c))
    assert found == ["VELOCITY_RULE: 7 INSTANT_SEPA in 60 min | risk_tier=PEP"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(datetime(1930, 1, 1), datetime(2199, 1, 1)), min_size=20, max_size=40))
def test_micros_and_iso_text_do_not_depend_on_the_session_zone(spark, times):
    # In these zones some of the wall-clock times do not exist or exist twice.
    times = [*times, datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30, 0, 1)]
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            frame = spark.createDataFrame(
                [(i, t) for i, t in enumerate(times)], "i int, v timestamp_ntz"
            )
            at = F.col("v")
            found = frame.orderBy("i").select(
                fn.micros(at), fn.from_micros(fn.micros(at)), fn.iso_text(at), fn.seconds(at)
            )
            for time, row in zip(times, found.collect()):
                expected = (time - datetime(1970, 1, 1)) // timedelta(microseconds=1)
                assert row[0] == expected
                assert row[1] == time
                assert row[2] == time.isoformat(timespec="microseconds")
                assert row[3] == expected // 1_000_000
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_timestamp_literal(spark):
    moment = datetime(2024, 3, 10, 2, 30, 0, 5)
    assert spark.range(1).select(fn.timestamp_ntz(moment)).first()[0] == moment


def test_packed_hashes_are_half_as_wide_and_come_back(spark):
    """Odd texts too; and they meet in a join exactly where the texts do."""
    from ledgerwatch.functions.columns import packed_hashes, unpacked_hashes

    texts = ["ab" * 32, "AB" * 32, "abc", "0abc", "", "xyz", "é", "00", "01", "\x00", None]
    df = spark.createDataFrame([(t, t) for t in texts], "sender_iban_hmac string, other string")
    packed = packed_hashes(df)
    assert unpacked_hashes(packed).collect() == df.collect()
    assert packed.selectExpr("octet_length(sender_iban_hmac)").first()[0] == 33
    assert packed.select("sender_iban_hmac").distinct().count() == len(texts)
