import gzip
import random

import pytest

from adlake.operators.projections import coerce
from adlake.schemas import SOURCE_COLUMNS
from adlake.sources import source_log
from adlake.sources.source_log import HEADER, limit_events, read_source_log


def line(n, **changes):
    values = {c: str(n) for c in SOURCE_COLUMNS} | {k: str(v) for k, v in changes.items()}
    return "\t".join(values.values())


def write(path, lines, opener=open):
    with opener(path, "wt") as out:
        out.write("\n".join(lines) + "\n")
    return str(path)


def numbers(frame):
    return sorted(r["line_number"] for r in frame.collect())


@pytest.mark.parametrize("header", [True, False])
def test_numbers_leave_gaps_for_bad_lines(spark, tmp_path, header):
    lines = [line(1), line(2) + "\t9", "", line(4).rsplit("\t", 1)[0], line(5)]
    path = write(tmp_path / "log.tsv", ([HEADER] if header else []) + lines)
    assert numbers(read_source_log(spark, path)) == [1, 5]
    assert numbers(read_source_log(spark, path, start_line=1)) == [5]
    assert numbers(read_source_log(spark, path, start_line=99)) == []


def test_gzip(spark, tmp_path):
    path = write(tmp_path / "log.tsv.gz", [HEADER] + [line(n) for n in range(1, 50)], gzip.open)
    frame = read_source_log(spark, path)
    assert {(r["line_number"], r["uid"]) for r in frame.collect()} == {(n, str(n)) for n in range(1, 50)}


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("header", [True, False])
def test_one_file_in_many_splits(spark, tmp_path, small_splits, header):
    lines = [line(n, uid=n) for n in range(1, 5001)]
    path = write(tmp_path / "log.tsv", ([HEADER] if header else []) + lines)
    frame = read_source_log(spark, path)
    assert frame.rdd.getNumPartitions() > 5
    assert all(int(r["uid"]) == r["line_number"] for r in frame.collect())
    assert frame.count() == 5000


def test_folder_of_files_in_name_order(spark, tmp_path, small_splits):
    """Files of very different size, so several share a partition out of order."""
    random.seed(3)
    folder, n = tmp_path / "log", 0
    folder.mkdir()
    for part in range(6):
        size = random.choice([1, 40, 900])
        lines = [line(i, uid=i) for i in range(n + 1, n + size + 1)]
        write(folder / f"part-{part}.tsv", ([HEADER] if part in (0, 3) else []) + lines)
        n += size
    got = {(r["line_number"], int(r["uid"])) for r in read_source_log(spark, str(folder)).collect()}
    assert got == {(i, i) for i in range(1, n + 1)}


def test_repeated_header_is_an_ordinary_bad_line(spark, tmp_path):
    path = write(tmp_path / "log.tsv", [HEADER, line(1), HEADER, line(3)])
    good, bad = coerce(read_source_log(spark, path))
    assert numbers(good) == [1, 3] and numbers(bad) == [2]


def test_coerce_quarantines_with_a_reason(spark, tmp_path):
    lines = [line(1, cost="1e3"), line(2, uid="abc"), line(3, cost=""), line(4, cat9="1.5", cpo="x"), line(5, uid="-1")]
    good, bad = coerce(read_source_log(spark, write(tmp_path / "log.tsv", lines)))
    assert {r["line_number"]: (r["uid"], r["cost"]) for r in good.collect()} == {1: (1, 1000.0), 5: (-1, 5.0)}
    reasons = {r["line_number"]: r["reject_reason"] for r in bad.collect()}
    assert reasons == {2: "not a number: uid", 3: "not a number: cost", 4: "not a number: cpo, cat9"}
    assert "abc" in bad.where("line_number = 2").first()["source_row"]


@pytest.mark.parametrize("n", [0, 1, 7, 10, 11, 40, 99, 100, 1000])
@pytest.mark.parametrize("width", [16, 1_000_000])
def test_limit(spark, monkeypatch, n, width):
    """Over numbers with gaps, in many ranges and in one."""
    monkeypatch.setattr(source_log, "LIMIT_RANGE", width)
    kept = [i for i in range(1, 150) if i % 3]
    frame = spark.createDataFrame([(i,) for i in kept], "line_number bigint")
    assert numbers(limit_events(frame, n)) == (kept[:n] if n else kept)


@pytest.mark.parametrize("start, most", [(0, 1), (0, 500), (0, 5000), (1, 1), (700, 900), (1999, 3), (4000, 10)])
def test_first_rows_over_many_files_and_splits(spark, tmp_path, small_splits, start, most):
    random.seed(7)
    folder, n, kept = tmp_path / "log", 0, []
    folder.mkdir()
    for part in range(7):
        lines = []
        for _ in range(random.choice([1, 30, 700])):
            n += 1
            bad = random.random() < 0.3
            lines.append(line(n) + "\t0" if bad else line(n, uid=n))
            if not bad:
                kept.append(n)
        write(folder / f"part-{part}.tsv", ([HEADER] if part in (0, 4) else []) + lines)
    frame = read_source_log(spark, str(folder), start, most)
    assert numbers(frame) == [i for i in kept if i > start][:most]
    assert all(int(r["uid"]) == r["line_number"] for r in frame.collect())


def test_first_rows_take_two_scans(spark, tmp_path):
    path = write(tmp_path / "log.tsv", [HEADER] + [line(n) for n in range(1, 50)])
    text = read_source_log(spark, path, max_events=10)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [") == 2 and "Sort" not in text.replace("SortOrder", "")
