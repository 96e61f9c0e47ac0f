from __future__ import annotations

import csv
import json
import os
from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators.settlements import settlement_eligible
from ledgerwatch.schemas import (
    CUSTOMERS,
    TRANSACTION_COLUMNS,
    TRANSACTION_REQUIRED,
    TRANSACTIONS,
)
from ledgerwatch.sources import bronze, exports, records
from ledgerwatch.sources.lake import Lake, path_exists, run_id
from ledgerwatch.workspace import scratch_root, stage_counted, staged

RUN = datetime(2024, 5, 1, 7)
AT = datetime(2024, 4, 28, 10, 0, 0, 123456)
ROW = ", ".join(
    f"{name} {'timestamp_ntz' if name == 'executed_at' else 'string'}" for name in TRANSACTION_COLUMNS
)


def payment(tid, amount="1,00", at=AT, status="SETTLED"):
    return (tid, "FR1", "DE1", amount, "EUR", "SEPA", status, None, at)


def write_file(spark, folder, day, rows):
    """A flat drop file, as the clearing network delivers it."""
    frame = spark.createDataFrame(rows, ROW)
    Path(folder).mkdir(exist_ok=True)
    pq.write_table(frame.toArrow(), f"{folder}/settlement_{day}.parquet")


def amounts(frame):
    return {r.transaction_id: r.amount for r in frame.collect()}


def test_settlement_files(spark, tmp_path):
    folder = f"{tmp_path}/drops"
    write_file(spark, folder, "2024-04-29", [payment("a", "1,00"), payment("b", "1,00")])
    write_file(spark, folder, "2024-04-30", [payment("a", "2,00"), payment("c", "2,00")])
    write_file(spark, folder, "2024-05-01", [])
    merged = bronze.load_settlements(spark, folder, RUN)
    assert amounts(merged) == {"a": "2,00", "b": "1,00", "c": "2,00"}
    assert {r.loaded_at for r in merged.collect()} == {RUN}
    assert merged.columns == [*TRANSACTION_COLUMNS, "loaded_at"]
    # The newest file is empty, so the one before it counts.
    assert amounts(bronze.load_settlements(spark, folder, RUN, "latest_file")) == {"a": "2,00", "c": "2,00"}
    with pytest.raises(ValueError):
        bronze.load_settlements(spark, folder, RUN, "other")


def test_latest_file_reads_only_that_file(spark, tmp_path):
    folder = f"{tmp_path}/drops"
    for day in range(1, 6):
        write_file(spark, folder, f"2024-04-0{day}", [payment(f"t{day}")])
    latest = bronze.load_settlements(spark, folder, RUN, "latest_file")
    assert amounts(latest) == {"t5": "1,00"}
    metrics = {}
    plan = latest._jdf.queryExecution().executedPlan()
    latest._jdf.queryExecution().toRdd().count()
    nodes = plan.collectLeaves()
    for i in range(nodes.size()):
        metric = nodes.apply(i).metrics().get("numFiles")
        if metric.isDefined():
            metrics["files"] = metric.get().value()
    assert metrics == {"files": 1}


def test_no_settlement_folder(spark, tmp_path):
    for mode in ("merge_latest", "latest_file"):
        assert bronze.load_settlements(spark, f"{tmp_path}/none", RUN, mode).isEmpty()


def test_exporting_a_day_again_replaces_only_that_day(spark, tmp_path):
    folder = f"{tmp_path}/out"
    rows = [(*payment("a"), date(2024, 5, 1)), (*payment("b"), date(2024, 5, 2))]
    schema = f"{ROW}, file_date date"
    exports.export_settlements(spark.createDataFrame(rows, schema), folder)
    exports.export_settlements(spark.createDataFrame([(*payment("c"), date(2024, 5, 2))], schema), folder)
    found = bronze.read_settlement_files(spark, folder).collect()
    assert {(r.transaction_id, r.file_date) for r in found} == {("a", date(2024, 5, 1)), ("c", date(2024, 5, 2))}
    assert {r.executed_at for r in found} == {AT}


def test_eligible_days(spark):
    day = date(2024, 5, 10)
    rows = [payment(f"d{back}", at=datetime(2024, 5, 10, 23, 59, 59) - timedelta(days=back), status="PENDING") for back in range(6)]
    rows += [
        payment("first-instant", at=datetime(2024, 5, 7), status="PENDING"),
        payment("too-early", at=datetime(2024, 5, 7) - timedelta(microseconds=1), status="PENDING"),
        payment("blocked", at=datetime(2024, 5, 8), status="BLOCKED"),
    ]
    frame = spark.createDataFrame(rows, ROW)
    found = {r.transaction_id for r in settlement_eligible(frame, day).collect()}
    assert found == {"d1", "d2", "d3", "first-instant"}
    assert {r.transaction_id for r in settlement_eligible(frame, F.lit(day)).collect()} == found


def test_eligible_days_reach_the_scan(spark, tmp_path):
    write_file(spark, f"{tmp_path}/in", "2024-05-01", [payment("a", status="PENDING")])
    frame = spark.read.schema(TRANSACTIONS).parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = settlement_eligible(frame, date(2024, 5, 10))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert "EqualTo(status,PENDING)" in pushed
    assert "GreaterThanOrEqual(executed_at" in pushed and "LessThan(executed_at" in pushed


def test_empty_source_leaves_bronze_as_it_is(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    source = spark.range(3)
    assert bronze.extract_to_bronze(source.limit(0), lake, "t", RUN) is None
    bronze.extract_to_bronze(source, lake, "t", RUN)
    kept = bronze.extract_to_bronze(source.limit(0), lake, "t", RUN + timedelta(hours=1))
    assert kept.count() == 3
    assert {r.ingested_at for r in kept.collect()} == {RUN}
    replaced = bronze.extract_to_bronze(source.limit(1), lake, "t", RUN + timedelta(hours=2))
    assert replaced.count() == 1 and lake.read("bronze", "t").count() == 1


def test_settlement_bronze_keeps_the_previous_load(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    assert bronze.settlements_to_bronze(lake, f"{tmp_path}/none", RUN).count() == 0
    write_file(spark, f"{tmp_path}/in", "2024-05-01", [payment("a")])
    later = RUN + timedelta(hours=1)
    assert bronze.settlements_to_bronze(lake, f"{tmp_path}/in", later).count() == 1
    last = RUN + timedelta(hours=2)
    assert bronze.settlements_to_bronze(lake, f"{tmp_path}/none", last).count() == 1


def test_lake_versions(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake/")
    one, two = RUN, RUN + timedelta(minutes=30)
    assert lake.read("gold", "t") is None and lake.read_all("gold", "t") is None
    lake.write(spark.range(1), "gold", "t", one)
    lake.write(spark.range(2), "gold", "t", two)
    assert lake.read("gold", "t").count() == 2
    assert lake.read("gold", "t", before=two).count() == 1
    assert lake.read("gold", "t", before=one) is None
    assert lake.read_all("gold", "t").count() == 3
    lake.write(spark.range(5), "gold", "t", two)
    assert lake.read_all("gold", "t").count() == 6
    # A version without its success mark has not committed.
    Path(f"{lake.folder('gold', 't')}/run=99999999T000000000000").mkdir()
    assert lake.read("gold", "t").count() == 5
    assert lake.folder(None, "t").endswith("/default/t")


def test_customers_csv(spark, tmp_path):
    row = ("C1", "Zoé", 'say "hi"', "e@x", None, "FR1", "1, rue", "Évry", "FR", "PEP", AT)
    customers = spark.createDataFrame([row], CUSTOMERS).coalesce(1)
    exports.export_customers_csv(customers, f"{tmp_path}/csv")
    assert tuple(exports.read_customers_csv(spark, f"{tmp_path}/csv").first()) == row
    (part,) = Path(f"{tmp_path}/csv").glob("*.csv")
    with open(part, encoding="utf-8", newline="") as file:
        lines = list(csv.reader(file))
    assert lines[0] == CUSTOMERS.fieldNames()
    assert lines[1][:4] == ["C1", "Zoé", 'say "hi"', "e@x"]


def test_publish_and_decode_round_trip(spark):
    rows = [payment("a"), payment("b", at=datetime(2024, 1, 1))]
    frame = spark.createDataFrame(rows, ROW)
    encoded = records.encode_events(frame)
    assert {r.key for r in encoded.collect()} == {"FR1"}
    body = json.loads(encoded.filter(F.col("value").contains('"b"')).first().value)
    assert list(body) == TRANSACTION_COLUMNS
    assert body["blocked_reason"] is None and body["executed_at"] == "2024-01-01T00:00:00.000000"
    valid, quarantine = records.validate_records(
        records.decode_events(encoded), TRANSACTION_REQUIRED, records.TRANSACTION_DOMAINS, ["executed_at"]
    )
    assert quarantine.isEmpty()
    assert valid.select(*frame.columns).exceptAll(frame).isEmpty() and valid.count() == 2


def test_validation_reasons_and_defaults(spark):
    bodies = [
        '{"transaction_id":"ok","sender_iban":"a","beneficiary_iban":"b","amount":"1","currency":"EUR","payment_channel":"CARD","executed_at":"2024-01-01T10:00:00.123456"}',
        '{"transaction_id":"two","beneficiary_iban":"b","amount":"1","currency":"EUR","payment_channel":"X","executed_at":"soon"}',
        "{broken",
        None,
    ]
    feed = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "arrival int, value string")
    filled = records.with_defaults(records.decode_events(feed), records.TRANSACTION_DEFAULTS)
    valid, quarantine = records.validate_records(
        filled, TRANSACTION_REQUIRED, records.TRANSACTION_DOMAINS, ["executed_at"]
    )
    good = valid.collect()
    assert [(r.transaction_id, r.status, r.executed_at, r.arrival) for r in good] == [
        ("ok", "PENDING", datetime(2024, 1, 1, 10, 0, 0, 123456), 0)
    ]
    reasons = {r.arrival: r.reason for r in quarantine.collect()}
    assert reasons[1] == "missing sender_iban; unknown payment_channel; bad executed_at"
    assert reasons[2] == reasons[3]
    assert reasons[2].startswith("missing transaction_id; missing sender_iban")


def test_quarantine_keeps_the_payload(spark):
    bodies = ["{broken", '{"transaction_id":"two","executed_at":"soon"}', None]
    feed = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "arrival int, value string")
    _, quarantine = records.validate_records(
        records.decode_events(feed, payload="payload"), TRANSACTION_REQUIRED, records.TRANSACTION_DOMAINS, ["executed_at"]
    )
    assert {r.arrival: r.payload for r in quarantine.collect()} == dict(enumerate(bodies))


def test_customer_defaults(spark):
    frame = spark.createDataFrame([("a",)], "customer_id string")
    assert records.with_defaults(frame, records.CUSTOMER_DEFAULTS).first().country == "FR"


def test_json_is_parsed_once(spark):
    feed = spark.createDataFrame([("{}",)], "value string")
    flagged = records.flag_records(
        records.decode_events(feed), TRANSACTION_REQUIRED, records.TRANSACTION_DOMAINS, ["executed_at"]
    ).filter("reason = ''")
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_staged_tables_live_in_the_shared_folder(spark):
    table, rows = stage_counted(spark.range(7), "t")
    assert rows == 7 and table.count() == 7
    assert all(scratch_root(spark) in file for file in table.inputFiles())


def test_staged_tables_of_a_block_are_deleted(spark):
    with staged(spark.range(3), "t") as (table, rows):
        files = table.inputFiles()
        assert rows == 3 and table.count() == 3
    assert not any(path_exists(spark, file) for file in files)


def test_old_versions_can_be_deleted(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    for batch in range(4):
        lake.write(spark.range(batch), "silver", "tail", batch)
    lake.keep_newest("silver", "tail", 2)
    assert lake.runs("silver", "tail") == ["000000000002", "000000000003"]
    assert lake.read("silver", "tail", before=3).count() == 2


def test_settlements_without_id_are_kept_apart(spark, tmp_path):
    folder = f"{tmp_path}/settlements"
    write_file(spark, folder, "2024-01-01", [payment(None), payment(None), payment("a")])
    write_file(spark, folder, "2024-01-02", [payment(None), payment("a", "2,00")])
    rows = bronze.load_settlements(spark, folder, RUN).collect()
    assert sorted(r.transaction_id or "" for r in rows) == ["", "", "", "a"]


def test_compaction_bounds_the_folders_and_keeps_the_rows(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    for run in range(30):
        lake.write(spark.createDataFrame([(run,)], "id int"), "silver", "t", run)
        lake.compact("silver", "t", fan=3)
        held = lake.pieces("silver", "t")
        assert [p[1] for p in held[-2:]] == [run_id(r) for r in range(max(run - 1, 0), run + 1)]
        assert len(held) <= 2 + 2 * 4
        folders = [p.name for p in (tmp_path / "lake/silver/t").iterdir() if not p.name.startswith(".")]
        assert len(folders) == len(held)
    assert sorted(r.id for r in lake.read_all("silver", "t").collect()) == list(range(30))
    assert sorted(r.id for r in lake.read_all("silver", "t", upto=run_id(28)).collect()) == list(range(29))
    with pytest.raises(ValueError):
        lake.read_all("silver", "t", upto=run_id(4))


def test_a_compaction_that_breaks_off_doubles_nothing(spark, tmp_path):
    """The folder of the range is committed, the single ones are still there; then one that is not committed."""
    lake = Lake(spark, f"{tmp_path}/lake")
    for run in range(4):
        lake.write(spark.createDataFrame([(run,)], "id int"), "silver", "t", run)
    both = spark.createDataFrame([(0,), (1,)], "id int").coalesce(1)
    folder = f"{lake.folder('silver', 't')}/range=1_{run_id(0)}_{run_id(1)}"
    both.write.parquet(folder)
    assert sorted(r.id for r in lake.read_all("silver", "t").collect()) == [0, 1, 2, 3]
    Path(f"{folder}/_SUCCESS").unlink()
    assert sorted(r.id for r in lake.read_all("silver", "t").collect()) == [0, 1, 2, 3]
    both.write.mode("overwrite").parquet(folder)
    lake.compact("silver", "t")
    assert [p[0] for p in lake.pieces("silver", "t")] == [run_id(0), run_id(2), run_id(3)] and lake.runs("silver", "t") == [run_id(2), run_id(3)]


def test_new_settlement_files_are_merged_and_old_ones_not_opened(spark, tmp_path):
    folder, lake = f"{tmp_path}/drops", Lake(spark, f"{tmp_path}/lake")

    def drop(day, rows):
        full = [(i, "FR1", "FR2", a, "EUR", "SEPA", "SETTLED", None, RUN) for i, a in rows]
        spark.createDataFrame(full, TRANSACTIONS).coalesce(1).write.parquet(f"{folder}/file_date={day}")

    def loaded(hour):
        rows = bronze.settlements_to_bronze(lake, folder, RUN + timedelta(hours=hour), "incremental")
        return sorted((r.transaction_id or "", r.amount, r.loaded_at.hour - RUN.hour) for r in rows.collect())

    assert loaded(0) == []
    drop("2024-01-05", [("a", "5"), ("b", "5"), (None, "5")])
    assert loaded(1) == [("", "5", 1), ("a", "5", 1), ("b", "5", 1)]
    drop("2024-01-04", [("a", "4"), ("c", "4"), (None, "4")])
    drop("2024-01-06", [("b", "6")])
    # The first file's rows are in the table; the file itself may be unreadable by now.
    for file in Path(f"{folder}/file_date=2024-01-05").glob("*.parquet"):
        stat = file.stat()
        file.write_bytes(b"x" * stat.st_size)
        os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    want = [("", "4", 2), ("", "5", 1), ("a", "5", 1), ("b", "6", 2), ("c", "4", 2)]
    assert bronze.new_settlement_files(lake, folder).count() == 2
    assert loaded(2) == want and loaded(2) == want  # a retried run replaces its own
    assert loaded(3) == want
    assert bronze.new_settlement_files(lake, folder).isEmpty()
