"""Readers, row checks and result writers on real files."""

import gzip

import pytest

from clustertrace import plans
from clustertrace.sources import (
    JOB_EVENTS,
    MACHINE_EVENTS,
    TASK_EVENTS,
    count_issues,
    new_path,
    parse_lines,
    read_job_events,
    read_machine_events,
    read_task_events,
    read_task_usage,
    rounded,
    shared_dir,
    validate_trace,
    with_log_count,
    write_result,
)
from tests.helpers import pairs

MACHINE_LINES = [
    ' 1 , 5 ,1,"x,0.25,0.2',
    "2,5,0,p,   ,0.5",
    "",
    "3,6,0,,0.5,",
]


def put(folder, name, lines):
    path = folder / name
    text = "".join(line + "\n" for line in lines)
    if name.endswith(".gz"):
        with gzip.open(path, "wt") as out:
            out.write(text)
    else:
        path.write_text(text)
    return str(path)


def test_fields_are_trimmed_and_quotes_are_plain_text(spark, tmp_path):
    path = put(tmp_path, "m.csv", MACHINE_LINES)
    rows = sorted(tuple(r) for r in read_machine_events(spark, path).collect())
    assert rows == [
        (1, 5, 1, '"x', 0.25, 0.2),
        (2, 5, 0, "p", None, 0.5),
        (3, 6, 0, None, 0.5, None),
    ]


def test_lines_of_text_parse_like_files(spark, tmp_path):
    path = put(tmp_path, "m.csv", MACHINE_LINES)
    lines = spark.createDataFrame([(line,) for line in MACHINE_LINES], "line string")
    parsed = parse_lines(lines, "line", MACHINE_EVENTS)
    assert parsed.schema.names == MACHINE_EVENTS.names
    assert sorted(map(str, parsed.collect())) == sorted(
        map(str, read_machine_events(spark, path).collect())
    )


@pytest.mark.parametrize("bad", ["x,5,0,p,0.5,0.5", "1,5.0,0,p,0.5,0.5", "1,5,0", "1,5,0,p,1,1,9"])
def test_strict_reads_raise_on_bad_rows(spark, tmp_path, bad):
    path = put(tmp_path, "m.csv", ["1,5,0,p,0.5,0.5", bad])
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|Malformed"):
        read_machine_events(spark, path).collect()
    lines = spark.createDataFrame([(bad,)], "line string")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        parse_lines(lines, "line", MACHINE_EVENTS).collect()


def test_pruned_reads_only_check_what_they_use(spark, tmp_path):
    path = put(tmp_path, "m.csv", ["1,5,0,p,0.5,huge", "2,6,0,p,0.5,0.5"])
    assert pairs(plans.capacity_distribution(read_machine_events(spark, path))) == {0.5: 2}


def test_several_parts_by_glob_and_list_plain_and_gzipped(spark, tmp_path):
    first = put(tmp_path, "part-00180-of-00500.csv", ["1,,7,0,u,3,n,l", "2,,7,1,u,3,n,l"])
    second = put(tmp_path, "part-00181-of-00500.csv.gz", ["3,,8,0,u,,n,l"])
    put(tmp_path, "part-00190-of-00500.csv", ["4,,9,0,u,0,n,l"])
    assert read_job_events(spark, str(tmp_path / "part-0018*")).count() == 3
    spread = read_job_events(spark, [first, second], partitions=6)
    assert spread.rdd.getNumPartitions() == 6
    assert sorted(r.job_id for r in spread.collect()) == [7, 7, 8]


def test_flags_become_booleans(spark, tmp_path):
    path = put(tmp_path, "t.csv", ["1,,7,0,,0,u,3,9,0.1,0.2,0.3,1", "1,,7,1,55,1,u,,9,,,,"])
    rows = sorted(read_task_events(spark, path).collect(), key=lambda r: r.task_index)
    assert [r.different_machines for r in rows] == [True, None]
    assert [(r.machine_id, r.cpu_request, r.priority) for r in rows] == [(None, 0.1, 9), (55, None, 9)]


def test_usage_columns(spark, tmp_path):
    path = put(tmp_path, "u.csv", ["1,2,3,4,5,0.5,.1,.2,.3,.4,.5,.6,.7,.8,.9,1.0,1.1,1.2,0,1.4"])
    row = read_task_usage(spark, path).first()
    assert (row.start_time, row.machine_id, row.cpu_rate) == (1, 5, 0.5)
    assert (row.sample_portion, row.aggregation_type, row.sampled_cpu_usage) == (1.2, False, 1.4)


def test_validation_counts_faulty_rows(spark, tmp_path):
    path = put(tmp_path, "m.csv", [
        "1,5,0,p,0.5,0.5",
        ",5,0,p,0.5,0.5",
        " ,,0,p,0.5,0.5",
        "x,5,0,p,0.5,0.5",
        "1,5,0,p,0.5,big",
        "1,5,0",
        "1,5,0,p,0.5,0.5,9",
        "",
        "1,5,,p,,",
    ])
    assert pairs(validate_trace(spark, path, MACHINE_EVENTS)) == {
        "malformed": 4,
        "missing time": 2,
        "missing machine_id": 1,
        "missing event_type": 1,
    }


def test_validation_of_a_clean_table_lists_all_checks(spark, tmp_path):
    path = put(tmp_path, "j.csv", ["1,,7,0,u,3,n,l"])
    assert pairs(validate_trace(spark, path, JOB_EVENTS)) == {
        "malformed": 0, "missing time": 0, "missing job_id": 0, "missing event_type": 0}
    assert [f.name for f in TASK_EVENTS.fields if not f.nullable] == [
        "time", "job_id", "task_index", "event_type", "priority"]


def test_validation_reads_lists_globs_and_gzip(spark, tmp_path):
    first = put(tmp_path, "part-1.csv", ["1,,7,0,u,3,n,l", "1,,x,0,u,3,n,l"])
    second = put(tmp_path, "part-2.csv.gz", ["1,,7,0,u,3,n", "1,,7,,u,three,n,l", " "])
    for path in ([first, second], str(tmp_path / "part-*")):
        found = pairs(validate_trace(spark, path, JOB_EVENTS))
        assert found == {"malformed": 3, "missing time": 0, "missing job_id": 0, "missing event_type": 0}


def test_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    def session(master, folder=""):
        conf = SimpleNamespace(get=lambda key, other: folder or other)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert new_path(session("yarn", "hdfs://a/b/"), "x").startswith("hdfs://a/b/x-")
    assert new_path(session("local[2]"), "x") != new_path(session("local"), "x")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://a:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))


@pytest.mark.parametrize("missing", ["zstandard", "tokenizers"])
def test_analytics_are_registered_without_the_packages_of_other_queries(missing):
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).parent.parent
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(sorted(e.PLANS) == sorted(set(e.queries()) & set(e.PLANS)))"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "True"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_results_are_written_and_read_back(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, 10, 0.123456), (2, 100, 0.5)], "x int, n long, y double")
    write_result(rounded(with_log_count(df, "n")), str(tmp_path / "out"), fmt)
    reader = spark.read if fmt == "parquet" else spark.read.option("header", True)
    back = reader.schema("x int, n long, y double, log10_n double").format(fmt)
    rows = back.load(str(tmp_path / "out")).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 10, 0.12, 1.0), (2, 100, 0.5, 2.0)]
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        write_result(df, str(tmp_path / "out"), fmt)


ODD_LINES = [
    "1,,7,3,5,0,u,1,9,0.5,0.1,0.1,1",
    "",
    "   ",
    "\t",
    " \t ",
    "2,,7,3,,1,u,,9,,,,",
    "3,,7,3,5,0,u,1,9,x,0.1,0.1,1",
    "4,,7,3,5,0,u,1,9",
    "5,,7,3,5,0,u,1,9,0.5,0.1,0.1,1,8",
    ",,7,3,5,0,u,1,9,0.5,0.1,0.1,0",
]


def test_lines_and_files_agree_on_odd_lines(spark, tmp_path):
    path = put(tmp_path, "t.csv", ODD_LINES)
    lines = spark.createDataFrame([(line,) for line in ODD_LINES], "line string")
    kept = parse_lines(lines, "line", TASK_EVENTS, malformed="bad")
    assert kept.columns == [*TASK_EVENTS.names, "bad"]
    of_lines = {r["issue"]: r["n_rows"] for r in count_issues(kept, TASK_EVENTS, "bad").collect()}
    of_files = {r["issue"]: r["n_rows"] for r in validate_trace(spark, path, TASK_EVENTS).collect()}
    assert of_lines == of_files == {"malformed": 3, "missing time": 1} | {
        f"missing {c}": 0 for c in ("job_id", "task_index", "event_type", "priority")
    }
    assert sorted(r["bad"] for r in kept.collect() if r["bad"] is not None) == sorted(ODD_LINES[6:9])
    sound = [line for k, line in enumerate(ODD_LINES) if k not in (6, 7, 8)]
    path = put(tmp_path, "sound.csv", sound)
    frame = spark.createDataFrame([(line,) for line in sound], "line string")
    assert sorted(map(str, parse_lines(frame, "line", TASK_EVENTS).collect())) == sorted(
        map(str, read_task_events(spark, path).collect())
    )


def test_null_lines_are_counted(spark):
    lines = spark.createDataFrame([(None,), (MACHINE_LINES[0],)], "line string")
    assert parse_lines(lines, "line", MACHINE_EVENTS).count() == 1
    kept = parse_lines(lines, "line", MACHINE_EVENTS, malformed="bad")
    assert [r["n_rows"] for r in count_issues(kept, MACHINE_EVENTS, "bad").collect()] == [1, 0, 0, 0]
