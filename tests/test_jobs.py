"""The jobs one after another, as an operator would run them."""

from datetime import datetime, timezone

from adlake.operators.projections import SOURCE_COLUMNS
from adlake.sources.source_log import HEADER
from adlake.streaming.metrics import OffsetListener
from adlake.tables.lake import Lake
from jobs import backfill, bootstrap, bronze_stream, gold, health, maintenance, replay, scaling, silver_stream


def log_line(n):
    values = {c: "0" for c in SOURCE_COLUMNS}
    values |= {"timestamp": str(n * 3600), "uid": str(n % 5), "campaign": str(n % 3), "click": "1", "cost": "0.5"}
    return "\t".join(values.values())


def test_whole_run(spark, tmp_path, capsys):
    root, log = str(tmp_path / "lake"), tmp_path / "log.tsv"
    log.write_text("\n".join([HEADER, *[log_line(n) for n in range(48)], log_line(1).replace("0.5", "half")]) + "\n")
    bootstrap.main(["--root", root])
    common = ["--root", root]
    replay.main([*common, "--input", str(log), "--format", "parquet", "--base-epoch", "1704067200"])
    bronze_stream.main([*common, "--format", "parquet", "--once"])
    silver_stream.main([*common, "--once"])
    lake = Lake(spark, root)
    assert lake.silver.read().count() == 48
    assert spark.read.parquet(f"{root}/quarantine/source_log").count() == 1

    gold.main([*common, "--start-date", "2024-01-01", "--end-date", "2024-01-02"])
    assert lake.daily.read().selectExpr("sum(events) AS n").first()["n"] == 48

    days = ["--event-start-date", "2024-01-01", "--event-end-date", "2024-01-01"]
    backfill.main([*common, *days])
    backfill.main([*common, *days, "--rebuild-gold"])
    gold.main([*common, "--changed"])
    gold.main([*common, "--changed"])
    assert lake.daily.read().selectExpr("sum(events) AS n").first()["n"] == 48

    maintenance.main([*common, "--action", "compact", "--tables", "silver"])
    maintenance.main([*common, "--change-retention-days", "0", "--change-retain-last", "1"])
    health.main([*common, "--as-of", "2024-01-03T00:00:00"])
    scaling.main([*common, "--current-max", "4"])  # a feed of files tells no lag
    output = capsys.readouterr().out
    assert "silver_duplicate_event_ids_7d" in output and output.count("unknown_lag") == 2
    progress = {"timestamp": datetime.now(timezone.utc).isoformat(), "batchId": 9, "sources": [{"endOffset": {"t": {"0": 5}}, "latestOffset": {"t": {"0": 300005}}}]}
    OffsetListener(spark, lake.topic_offsets, "kafka_to_bronze").record(progress)
    scaling.main([*common, "--current-max", "4"])
    output = capsys.readouterr().out
    assert "300000" in output and "scale_up" in output and output.count("unknown_lag") == 1
    assert lake.silver.read().count() == 48


def test_replay_bounds(spark, tmp_path):
    root, log = str(tmp_path / "lake"), tmp_path / "log.tsv"
    log.write_text("\n".join(log_line(n) for n in range(20)) + "\n")
    replay.main(["--root", root, "--input", str(log), "--format", "parquet", "--start-line", "5", "--max-events", "7"])
    offsets = [r["offset"] for r in spark.read.parquet(f"{root}/feed").collect()]
    assert sorted(offsets) == list(range(6, 13))
