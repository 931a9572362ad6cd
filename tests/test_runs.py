import os
from datetime import datetime, timedelta

import pytest
from conftest import RUN_AT, by, one
from pyspark.errors import PySparkException
from test_clean import COMPLETE, ENGLISH, PADDED

from sitewright.operators import runs
from sitewright.operators.rules import Limits
from sitewright.plans import daily
from sitewright.plans.curate import curated, transform_listings
from sitewright.plans.daily import run_day, volume_warning
from sitewright.plans.report import GoldSet
from sitewright.schema import RUN_SCHEMA
from sitewright.sources import history, landing, tables
from sitewright.sources.journal import Journal, flat_run, read_journal, stage_states

NOW = datetime(2026, 1, 31, 12, 0)


def records(spark, n):
    rows = [
        ((NOW - timedelta(days=n - 1 - i)).isoformat(), f"day {i}", f"scheduled__{i:020d}", "success")
        + (None,) * (len(RUN_SCHEMA) - 4)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


@pytest.mark.parametrize("n", [0, 1, 100, 101])
def test_history_keeps_the_last_hundred(spark, n):
    kept = runs.retained_runs(records(spark, n)).collect()
    assert len(kept) == min(n, 100)
    if n:
        assert kept[-1]["execution_date"] == f"day {n - 1}"
        assert kept[0]["execution_date"] == f"day {max(n - 100, 0)}"
    assert len(runs.latest_run(records(spark, n)).collect()) == min(n, 1)


def test_last_runs(spark):
    df = records(spark, 5)
    assert [r["execution_date"] for r in runs.last_n_runs(df, 2).collect()] == ["day 3", "day 4"]
    for everything in (None, 0):
        assert [r["execution_date"] for r in runs.last_n_runs(df, everything).collect()] == [
            f"day {i}" for i in range(5)
        ]


def test_window_includes_its_edge(spark):
    got = runs.run_history_window(records(spark, 60), NOW, 30).collect()
    assert len(got) == 31
    assert min(r["execution_timestamp"] for r in got) == NOW - timedelta(days=30)


def test_defaults_for_missing_values(spark):
    df = spark.createDataFrame([(NOW.isoformat(),) + (None,) * (len(RUN_SCHEMA) - 1)], RUN_SCHEMA)
    assert one(runs.run_history_flat(df)).asDict() == {
        "execution_date": "N/A", "status": "unknown", "records": 0, "total_time": 0.0, "bronze_time": 0.0,
        "silver_time": 0.0, "gold_time": 0.0,
    }
    card = one(runs.latest_run_card(df))
    assert (card["execution_date"], card["status"], card["run_id"], card["data_loss_rate"]) == (
        "N/A", "UNKNOWN", "N/A", 0.0,
    )
    layers = by(runs.run_validation_table(df), "layer")
    assert set(layers) == {"bronze", "silver", "gold"}
    assert {(r["success"], r["success_rate"], r["total"]) for r in layers.values()} == {(False, 0.0, 0)}
    assert set(one(runs.enrichment_card(df))) == {0.0}
    gate = one(runs.stage_gates(df))
    assert not gate["may_curate"] and gate["verdict"] == "bronze layer did not succeed"


def test_run_id_is_shortened(spark):
    assert one(runs.latest_run_card(records(spark, 2)))["run_id"] == "0" * 15


def test_gates_fail_with_the_reason(spark):
    with pytest.raises(PySparkException, match="bronze layer did not succeed"):
        runs.require_stages(records(spark, 1)).collect()


def test_reconciliation(spark):
    row = one(runs.layer_reconciliation(spark.range(100), spark.range(94)))
    assert (row["data_loss_rate"], row["retention_rate"], row["loss_warning"]) == (6.0, 94.0, True)
    row = one(runs.layer_reconciliation(spark.range(20), spark.range(19)))
    assert (row["data_loss_rate"], row["loss_warning"]) == (5.0, False)
    row = one(runs.layer_reconciliation(spark.range(0), spark.range(0)))
    assert (row["data_loss_rate"], row["retention_rate"], row["loss_warning"]) == (0.0, None, False)


def test_a_whole_run_and_its_history(spark, listings, tmp_path):
    base = str(tmp_path / "lake")
    schema = "key string, latitude double, longitude double"
    by_city = spark.createDataFrame([("Boise, United States", 43.6, -116.2)], schema)
    batch = listings(COMPLETE, PADDED, ENGLISH)
    first = one(run_day(spark, batch, base, RUN_AT, "scheduled__1", (by_city.limit(0), by_city)))
    assert first["status"] == "success"
    assert first["data_quality"]["records_transformed"] == 3
    assert first["data_quality"]["aggregations_created"] == 7
    assert first["silver_layer"]["countries"] == 2
    assert first["silver_layer"]["enrichment"]["geocoded_rate"] == pytest.approx(1 / 3)
    # Three rows are too few for the volume rule, which does not fail the run.
    assert not first["validation_results"]["bronze"]["success"]
    assert first["validation_results"]["gold"]["total_aggregations"] == 7
    assert first["execution_times"]["bronze_ingestion_time"] == 0.5
    second = one(run_day(spark, listings(), base, RUN_AT + timedelta(days=1), "scheduled__2"))
    assert second["status"] == "failed" and second["data_quality"]["records_transformed"] == 0
    kept = history.read_runs(spark, f"{base}/runs")
    assert [r["dag_run_id"] for r in kept.collect()] == ["scheduled__1", "scheduled__2"]
    card = one(runs.latest_run_card(kept))
    assert (card["status"], card["run_id"]) == ("FAILED", "2")
    gates = by(runs.stage_gates(kept), "execution_timestamp")
    assert gates[RUN_AT.isoformat()]["may_report"]
    assert tables.read_gold(spark, f"{base}/gold", "breweries").count() == 3


def test_the_record_is_read_back_whole(spark, listings, tmp_path):
    base = str(tmp_path / "lake")
    limits = Limits(bronze_rows=(1, 9), silver_rows=(1, 9))
    row = one(run_day(spark, listings(COMPLETE, PADDED, ENGLISH), base, RUN_AT, "scheduled__1", limits=limits))
    kept = one(history.read_runs(spark, f"{base}/runs"))
    assert kept.asDict(recursive=True) == row.asDict(recursive=True)
    assert kept["rule_results"]["silver_success_rate"] > 0 and kept["validation_results"]["bronze"]["passed"] >= 7
    assert kept["bronze_layer"]["records"] == 3 and "batch-" in kept["bronze_layer"]["path"]
    assert kept["gold_layer"]["aggregations"] == 7 and kept["gold_layer"]["processing_time"] > 0
    quality = kept["silver_layer"]["quality"]
    assert (quality["unique_ids"], quality["complete_records"], quality["coordinate_coverage"]) == (3, 1, 66.67)
    assert kept["failed_stage"] is None and kept["error"] is None


STAGES = {
    "land": (landing, "ingest"), "check_bronze": (daily, "volume_warning"), "curate": (daily, "transform_listings"),
    "check_silver": (daily.rules, "summary_or_failure"), "report": (daily, "build_gold"), "check_gold": (daily, "_gold_suite"),
}


@pytest.mark.parametrize("stage", list(STAGES))
def test_a_stage_that_raises_is_on_record(spark, listings, tmp_path, monkeypatch, stage):
    base = str(tmp_path / "lake")
    module, name = STAGES[stage]
    real = getattr(module, name)

    def broken(*args, **kwargs):
        if stage == "check_silver" and args[1] != "silver":
            return real(*args, **kwargs)
        raise OSError("disk gone")

    monkeypatch.setattr(module, name, broken)
    row = one(run_day(spark, listings(COMPLETE, PADDED), base, RUN_AT, "scheduled__1"))
    assert (row["failed_stage"], row["error"]) == (stage, "OSError: disk gone")
    kept = one(history.read_runs(spark, f"{base}/runs"))
    assert kept["failed_stage"] == stage
    if stage not in ("check_gold",):
        assert kept["status"] == "failed"
    states = {r["stage"]: r["state"] for r in stage_states(read_journal(spark, f"{base}/journal")).collect()}
    order = list(STAGES)
    assert states == {x: "success" if order.index(x) < order.index(stage) else "failed" if x == stage else "skipped" for x in order}


def test_a_killed_run_is_folded_up_to_its_stage(spark, tmp_path):
    journal = Journal(spark, str(tmp_path / "journal"), NOW, "scheduled__9")
    journal.run("land", lambda: {"bronze_status": "success", "bronze_records": 5})
    journal.note("curate", "begun")
    row = one(runs.run_report(flat_run(read_journal(spark, journal.path), daily.FOUND, NOW, "scheduled__9")))
    assert (row["failed_stage"], row["status"], row["data_quality"]["records_ingested"]) == ("curate", "failed", 5)
    assert row["validations"]["bronze"] and not row["validations"]["silver"]


def test_history_is_compacted(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i in range(4):
        history.append_run(records(spark, 5).where(f"execution_date = 'day {i}'"), path)
    dates = lambda df: [r["execution_date"] for r in df.orderBy("execution_timestamp").collect()]
    assert dates(history.compact_runs(spark, path, keep=3)) == ["day 1", "day 2", "day 3"]
    assert not [f for f in os.listdir(path) if f.startswith("part-")]
    history.append_run(records(spark, 5).where("execution_date = 'day 4'"), path)
    # A run that is still in its file, as after a compaction that was killed, counts once.
    history.append_run(records(spark, 5).where("execution_date = 'day 3'"), path)
    assert dates(history.read_runs(spark, path)) == ["day 1", "day 2", "day 3", "day 4"]
    assert dates(history.compact_runs(spark, path, keep=2)) == ["day 3", "day 4"]
    assert history.read_runs(spark, path).schema == RUN_SCHEMA


def rows_read(spark, path, work):
    """Rows that scans of files under the path gave while the work was done."""
    total = 0
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    executions = store.executionsList(int(before), 10_000)
    for i in range(executions.size()):
        execution = executions.apply(i)
        graph = store.planGraph(execution.executionId())
        values = store.executionMetrics(execution.executionId())
        nodes = graph.allNodes()
        for j in range(nodes.size()):
            node = nodes.apply(j)
            if not node.name().startswith("Scan") or path not in node.desc():
                continue
            for k in range(node.metrics().size()):
                metric = node.metrics().apply(k)
                if metric.name() == "number of output rows":
                    found = values.get(metric.accumulatorId())
                    total += int(found.get().replace(",", "")) if found.isDefined() else 0
    return total


def test_a_run_reads_silver_once_for_values_and_the_tables_read_the_rest(spark, listings, tmp_path):
    silver = str(tmp_path / "silver")
    batch = listings(*[{**COMPLETE, "id": f"r-{i}"} for i in range(40)])
    assert rows_read(spark, silver, lambda: transform_listings(spark, batch, silver, RUN_AT).quality.collect()) == 40


def test_a_gold_set_reads_the_listings_once(spark, listings, tmp_path):
    source = str(tmp_path / "source")
    curated(listings(*[{**COMPLETE, "id": f"r-{i}"} for i in range(40)]), RUN_AT).write.parquet(source)
    with GoldSet(spark, lambda: spark.read.parquet(source), RUN_AT) as shared:

        def ask():
            assert one(shared.table("brewery_summary_statistics"))["total_breweries"] == 40
            assert len(shared.tables()) == 7 and shared.silver().count() == 40
            shared.table("breweries_by_country").collect()

        assert rows_read(spark, source, ask) == 40
        base = shared.base
        assert os.path.exists(base)
    assert not os.path.exists(base)


def test_volume_is_compared_with_the_batch_before(spark, listings, tmp_path, caplog):
    base = str(tmp_path / "bronze")
    landing.ingest(listings(COMPLETE, PADDED), base, RUN_AT)
    assert not volume_warning(spark, base)
    landing.ingest(listings(COMPLETE, PADDED, ENGLISH), base, RUN_AT + timedelta(days=40))
    assert volume_warning(spark, base)
    assert "changed by 50.0 %: 2 rows before, 3 now" in caplog.text


def test_no_history_yet(spark, tmp_path):
    assert history.read_runs(spark, str(tmp_path / "none")).collect() == []
