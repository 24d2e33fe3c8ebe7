"""Lines accounted for, inferred types, headers by file, stored route state and replaced reports."""

from __future__ import annotations

import csv
import io
import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark import Broadcast
from pyspark.sql import functions as F

from hand import HAND_CSV
from skyledger import operators as ops, sinks, sources
from skyledger.operators import Fields
from skyledger.plans import (
    JOBS,
    ROUTE_PRESETS,
    SHARED,
    merge_batch,
    merge_job,
    read_for,
    read_state,
    route_stats,
    run_job,
    run_jobs,
    shared_reports,
    shared_state,
    state_job,
    state_report,
)
from skyledger.schema import FLIGHT_COLUMNS, PAIR_KEYS
from skyledger.sources import layouts, records
from skyledger.workloads.queries import QUERIES

HEADER = list(FLIGHT_COLUMNS)
LINES = [
    ("1", "AA", "JFK", "LAX", "5", "7", "0"),
    ("13", "AA", "JFK", "LAX", "None", "", "0.0"),
    ("1", "  ", "JFK", "LAX", "5", "7", "0"),
    ("1", "AA", None, "LAX", "5", "7", "0"),
    ("1", "AA", "JFK", " dest ", "5", "7", "0"),
    tuple(HEADER),
    ("x", "AA", "JFK", "LAX", "5", "7", "0"),
    (None, "AA", "JFK", "LAX", "5", "7", "0"),
    ("1", "AA", "JFK", "LAX", "late", "7", "1"),
    ("1", "AA", "JFK", "LAX", "5", "NaN", "0"),
    ("1", "AA", "JFK", "LAX", "5", "7", "None"),
    ("1", "AA", "JFK", "LAX", "5", "7", "yes"),
]
EVERY_FIELDS = [
    Fields(),
    *(rules.fields for rules in ROUTE_PRESETS.values()),
    *(job.fields for job in JOBS.values()),
    Fields(PAIR_KEYS, "unread", "zero", ("dep_delay",), cancelled_delays=False),
]


def write_lines(path, rows, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerows([header, *rows] if header else rows)
    return str(path)


# ---- rejects


@pytest.mark.parametrize("fields", EVERY_FIELDS)
def test_a_reason_for_exactly_the_lines_that_are_dropped(spark, fields):
    schema = ", ".join(f"{name} string" for name in HEADER)
    values = {name: {row[i] for row in LINES} for i, name in enumerate(HEADER)}
    rows = [tuple(v if j == i else LINES[k][j] for j in range(7)) for i, name in enumerate(HEADER) for v in values[name] for k in (0, 8)]
    text = spark.createDataFrame([*LINES, *rows], schema).select(F.monotonically_increasing_id().alias("n"), "*")
    reasons = {r.n for r in text.where(ops.reject_reason(fields).isNull()).select("n").collect()}
    assert reasons == {r.n for r in ops.clean(text, fields).select("n").collect()}


def test_accounted(spark, tmp_path):
    file = write_lines(tmp_path / "in" / "a.csv", LINES)
    account = sources.read_accounted(spark, file)
    assert account.lines == len(LINES) + 1  # the header line is a line
    left_out = {name: n for name, n in account.reasons.items() if n}
    assert left_out == {
        "blank op_unique_carrier": 1,
        "header in op_unique_carrier": 2,
        "blank origin": 1,
        "header in dest": 1,
        "bad month": 1,
        "missing month": 1,
        "bad dep_delay": 1,
        "bad arr_delay": 1,
        "missing cancelled": 1,
        "bad cancelled": 1,
    }
    assert account.flights.count() + sum(left_out.values()) == account.lines
    assert sorted(map(str, account.flights.collect())) == sorted(map(str, sources.read_flights(spark, file).collect()))
    rejects = account.rejects.collect()
    assert Counter(r.reason for r in rejects) == Counter(left_out)
    assert {(r.reason, r.month, r.dep_delay) for r in rejects} >= {("bad month", "x", "5"), ("bad dep_delay", "1", "late")}
    assert all(r.file.endswith("/in/a.csv") for r in rejects)


def test_accounted_reads_the_files_once(spark, tmp_path):
    """The plan of the one write has one scan; what follows reads the written table."""
    account = sources.read_accounted(spark, write_lines(tmp_path / "a.csv", LINES))
    for frame in (account.flights, account.rejects):
        assert all("a.csv" not in file for file in frame.inputFiles())


def test_accounted_lines_are_not_parted_by_a_sort(spark, tmp_path):
    """Written into a folder each for kept lines and rejects, all lines of a task would be sorted in memory first."""
    account = sources.read_accounted(spark, write_lines(tmp_path / "a.csv", LINES))
    files = account.flights.inputFiles()
    assert sorted(files) == sorted(account.rejects.inputFiles()) != []
    assert not any("rejected=" in file for file in files)


def test_accounted_without_lines(spark, tmp_path):
    account = sources.read_accounted(spark, write_lines(tmp_path / "a.csv", [], HEADER))
    assert (account.lines, sum(account.reasons.values()), account.flights.count(), account.rejects.count()) == (1, 1, 0, 1)


@pytest.mark.parametrize("name", ["route_stats_arr", "ranking_zero_excl", "ranking_zero_dedupe", "airport_mean"])
def test_job_with_rejects(spark, tmp_path, name):
    file = write_lines(tmp_path / "a.csv", LINES)
    run_job(spark, name, file, str(tmp_path / "plain"))
    counts = run_job(spark, name, file, str(tmp_path / "accounted"), rejects_path=str(tmp_path / "rejects"))

    def report(folder):
        return sorted(line for part in Path(tmp_path, folder).glob("part-*") for line in part.read_text().splitlines())

    assert report("plain") == report("accounted") != []
    rejects = spark.read.csv(str(tmp_path / "rejects"), header=True)
    assert counts.pop("lines") == counts.pop("kept") + sum(counts.values()) == len(LINES) + 1
    assert Counter(r.reason for r in rejects.collect()) == Counter({k: n for k, n in counts.items() if n})


# ---- inferred types


def test_types(spark):
    rows = [
        ("1", "2147483648", "1", " 2 ", None, "1e3", "a", "9223372036854775808", "+5"),
        ("-7", "3", "2.50", "None", "", "NaN", "1", "0", "-2147483648"),
    ]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, `g.h` string, i string, j string")
    types = {r.column: r.type for r in sources.infer_types(df).collect()}
    assert types == dict(a="int", b="bigint", c="double", d="int", e="void", f="string", i="double", j="int") | {"g.h": "string"}
    typed = sources.cast_inferred(df, types)
    assert [t for _, t in typed.dtypes] == ["int", "bigint", "double", "int", "string", "string", "string", "double", "int"]
    assert tuple(typed.collect()[1]) == (-7, 3, 2.5, None, "", "NaN", "1", 0.0, -(2**31))


def test_types_merge_like_one_scan(spark):
    whole = spark.createDataFrame([(str(v), w) for v, w in zip([1, 2, 2**40, "x"], ["1", None, "2.0", ""])], "a string, b string")
    parts = [sources.infer_types(whole.where(F.col("a") == a)) for a in ("1", "2", str(2**40), "x")]
    merged = sources.merge_types(*parts[:2], sources.merge_types(*parts[2:]))
    assert sorted(merged.collect()) == sorted(sources.infer_types(whole).collect())
    assert sorted(sources.merge_types(*parts[:3]).collect()) == [("a", "bigint"), ("b", "double")]
    assert [r.type for r in sources.infer_types(whole.limit(0)).collect()] == ["void", "void"]


def test_types_take_one_aggregate(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    plan = sources.infer_types(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan


# ---- headers by file


def test_driver_opens_no_file(spark, tmp_path, monkeypatch):
    orders = [HEADER, HEADER[::-1], HEADER[2:] + HEADER[:2]]
    for i in range(30):
        row = dict(zip(HEADER, (str(i % 12 + 1), "AA", f"A{i}", "B", "1", "2", "0")))
        write_lines(tmp_path / f"in {i % 4}" / f"{i} %41 [x].csv", [[row[c] for c in orders[i % 3]]], orders[i % 3])
    (tmp_path / "in 0" / "empty.csv").write_text("")
    heads = sources.file_heads(spark, f"{tmp_path}/in*")
    assert heads.count() == 30 and heads.select("file").distinct().count() == 30
    rows = [r.value for r in spark.read.text(f"{tmp_path}/in*").limit(1).collect()]
    assert rows  # the folder can be read as it is
    found = sources.column_orders(spark, f"{tmp_path}/in*")
    assert sorted(names for names, _ in found) == sorted(orders) and sorted(len(files) for _, files in found) == [10, 10, 10]
    monkeypatch.setattr("builtins.open", lambda *a, **k: pytest.fail("the driver opens a file"))
    flights = sources.read_flights(spark, f"{tmp_path}/in*")
    assert sorted(r.origin for r in flights.collect()) == sorted(f"A{i}" for i in range(30))


def test_large_files_are_a_task_each(spark, tmp_path, monkeypatch):
    """Small ones share tasks; the caller's settings stay as they are, and a split in the middle of a file gives no head."""
    for i in range(20):
        write_lines(tmp_path / "in" / f"{i}.csv", [("1",) * 7] * (1 + 40 * (i % 2)))
    monkeypatch.setattr(layouts, "SMALL", 200)
    before = {key: spark.conf.get(key, None) for key in layouts.ONE_FILE_A_TASK}
    heads = sources.file_heads(spark, str(tmp_path / "in"))
    assert heads.rdd.getNumPartitions() < 20 and sorted(r.width for r in heads.collect()) == [7] * 20
    large = layouts._one_file_a_task(spark).read.text(str(tmp_path / "in")).where(F.col("_metadata.file_size") > 200)
    assert large.rdd.getNumPartitions() == 10
    assert {key: spark.conf.get(key, None) for key in layouts.ONE_FILE_A_TASK} == before


def test_heads_read_the_first_line_only(spark, tmp_path):
    """A file whose later lines are not even text of the right encoding, and one whose first line is quoted."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes((",".join(HEADER) + "\n").encode() + os.urandom(3_000_000))
    (tmp_path / "in" / "b.csv").write_text(",".join(f'" {c.upper()} "' for c in HEADER) + "\n")
    (tmp_path / "in" / "c.csv").write_text('"a, b",2\n')
    heads = {Path(r.file).name: (r.names, r.width) for r in sources.file_heads(spark, str(tmp_path / "in")).collect()}
    assert heads == {"a.csv": (HEADER, 7), "b.csv": (HEADER, 7), "c.csv": (None, 2)}


# ---- stored state


@pytest.mark.parametrize("name", sorted(ROUTE_PRESETS))
def test_state_equals_one_run(spark, tmp_path, name):
    rules = ROUTE_PRESETS[name]
    rows = [(m, c, o, "X", d, d, x) for i, (m, c, o, d, x) in enumerate(
        (1 + i % 14, f"C{i % 3}", f"O{i % 5}", None if i % 7 == 0 else float(i % 11) - 3.5, [0.0, 1.0, None][i % 3 if i % 4 else 0]) for i in range(300)
    )]
    rows.append((40, "C0", "O0", "X", 1.0, 1.0, 0.0))  # a month of another block
    flights = spark.createDataFrame(rows, "month int, op_unique_carrier string, origin string, dest string, dep_delay double, arr_delay double, cancelled double")
    state, batch = str(tmp_path / "state"), F.pmod(F.xxhash64("month", "origin"), F.lit(3))
    for i in (0, 1, 2, 1):
        merge_batch(flights.where(batch == i), rules, state, f"b{i}")
    expected = sorted(map(str, route_stats(flights, rules).collect()))
    assert sorted(map(str, state_report(spark, rules, state).collect())) == expected
    # A batch sent again counts once; with other flights it takes the place of what it had.
    merge_batch(flights.where(batch == 9), rules, state, "b1")
    assert sorted(map(str, state_report(spark, rules, state).collect())) == sorted(map(str, route_stats(flights.where(batch != 1), rules).collect()))
    assert {r.batch for r in read_state(spark, rules, state).select("batch").distinct().collect()} == {"b0", "b2"}


def test_a_failing_batch_leaves_the_state_as_it_was(spark, tmp_path, hand_csv):
    state, rules = str(tmp_path / "state"), ROUTE_PRESETS["route_stats_arr"]
    merge_job(spark, "route_stats_arr", hand_csv, state, "2024-01")
    before = sorted(map(str, state_report(spark, rules, state).collect()))
    bad = sources.read_flights(spark, hand_csv).withColumn("month", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        merge_batch(bad, rules, state, "2024-01")
    assert sorted(map(str, state_report(spark, rules, state).collect())) == before
    with pytest.raises(ValueError, match="letters"):
        merge_batch(bad, rules, state, "../x")


def test_state_job(spark, tmp_path):
    header, *lines = HAND_CSV.strip().splitlines()
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("\n".join([header, *lines[i::3]]) + "\n")
        merge_job(spark, "route_stats_dep_flat", str(tmp_path / f"{i}.csv"), str(tmp_path / "state"), f"b{i}")
    (tmp_path / "all.csv").write_text(HAND_CSV)
    state_job(spark, "route_stats_dep_flat", str(tmp_path / "state"), str(tmp_path / "merged"))
    run_job(spark, "route_stats_dep_flat", str(tmp_path / "all.csv"), str(tmp_path / "whole"))
    merged, whole = (sorted(spark.read.csv(str(tmp_path / p), header=True).collect()) for p in ("merged", "whole"))
    assert merged == whole != []


# ---- replaced reports


WRITERS = {
    sinks.write_json: ("n long", lambda df: df),
    sinks.write_csv: ("n long", lambda df: df),
    sinks.write_parquet: ("n long", lambda df: df),
    sinks.write_text: ("value string", lambda df: df.selectExpr("CAST(n AS STRING) AS value")),
    sinks.write_airport_means: ("", lambda df: df.selectExpr("CAST(n AS STRING) AS origin", "1.5D AS airport_mean")),
}


@pytest.mark.parametrize("write", WRITERS, ids=lambda w: w.__name__)
def test_a_failing_job_leaves_the_old_report(spark, tmp_path, write):
    shape = WRITERS[write][1]
    path = tmp_path / "reports" / "report"
    write(shape(spark.range(10).toDF("n")), str(path))
    before = {f.name: f.read_bytes() for f in path.iterdir()}
    late = F.when(F.col("id") < 990, F.col("id")).otherwise(F.raise_error(F.lit("broken late")).cast("long"))
    with pytest.raises(Exception, match="broken late"):
        write(shape(spark.range(0, 1000, 1, 8).select(late.alias("n"))), str(path))
    assert {f.name: f.read_bytes() for f in path.iterdir()} == before
    assert [f.name for f in path.parent.iterdir()] == ["report"]
    write(shape(spark.range(3).toDF("n")), str(path))
    rows = sum(len(f.read_text(errors="replace").splitlines()) for f in path.glob("part-*") if f.suffix != ".parquet")
    assert write is sinks.write_parquet or rows in (3, 3 + len(list(path.glob("part-*.csv"))))
    assert [f.name for f in path.parent.iterdir()] == ["report"]


def test_a_report_may_replace_what_it_is_made_of(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.range(5), path)
    sinks.write_parquet(spark.read.parquet(path).where("id > 2"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [3, 4]


def test_a_rename_that_fails_puts_the_old_table_back(spark, tmp_path):
    path = tmp_path / "t"
    sinks.write_parquet(spark.range(5), str(path))
    with pytest.raises(OSError, match="can't be moved"):
        sinks.staged_replace(spark, str(path), lambda beside: None)  # nothing was written
    assert spark.read.parquet(str(path)).count() == 5 and [f.name for f in tmp_path.iterdir()] == ["t"]


# ---- several reports from one scan


def test_shared_scan_equals_the_single_jobs(spark, tmp_path):
    values = [{row[i] for row in LINES} for i in range(7)]
    rows = [tuple(sorted(map(str, v))[(i * (j + 3) + i // 7) % len(v)] for j, v in enumerate(values)) for i in range(900)]
    rows = [tuple(None if v == "None" and i % 2 else v for v in row) for i, row in enumerate(rows)] + LINES * 3
    file = write_lines(tmp_path / "a.csv", [("7" if i % 3 else row[0], *row[1:]) for i, row in enumerate(rows)])
    reports = shared_reports(spark, file)
    assert set(reports) == set(SHARED) == set(JOBS) - {"ranking_zero_dedupe"}
    for name, report in reports.items():
        single = JOBS[name].report(read_for(spark, JOBS[name], file))
        assert sorted(map(str, report.collect())) == sorted(map(str, single.collect())), name
        assert report.columns == single.columns
    run_jobs(spark, file, {"ranking_sql": str(tmp_path / "r"), "airport_mean": str(tmp_path / "m")}, {"ranking_sql": "text"})
    run_job(spark, "ranking_sql", file, str(tmp_path / "r1"), "text")
    read = [sorted(line for p in (tmp_path / d).glob("part-*") for line in p.read_text().splitlines()) for d in ("r", "r1")]
    assert read[0] == read[1] != []
    with pytest.raises(ValueError, match="can't share"):
        shared_state(spark, file, ["ranking_zero_dedupe"])


def test_shared_state_is_one_scan_and_one_aggregate(spark, tmp_path):
    file = write_lines(tmp_path / "a.csv", LINES)
    plan = shared_state(spark, file)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "HashAggregate" in plan and "ObjectHash" not in plan
    airport = shared_state(spark, file, ["airport_mean"])._jdf.queryExecution().executedPlan().toString()
    assert "arr_delay" not in airport and "field_0" not in airport
    assert shared_state(spark, file, ["route_stats_dep_flat", "route_stats_dep_nested"]).columns == shared_state(spark, file, ["route_stats_dep_flat"]).columns


# ---- quoted line breaks in files that are cut


def records_of(spark, path, split, **more):
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    reader.conf.set("spark.sql.files.openCostInBytes", "0")
    return sources.read_records(reader, str(path), **more)


@pytest.mark.parametrize("split", [7, 16, 61, 500, 1 << 20])
def test_records_at_any_cut(spark, tmp_path, split):
    """Against Python's reader, which reads a file from its beginning."""
    fields = ["a", "", "x,y", 'say "hi"', "two\nlines", "\n", '"\n\n"', "end\r", "long " * 12 + "\n" + "tail " * 9, "é\n日本", '""']
    rows = [(fields[i % 11], fields[i * 7 % 11], str(i), fields[i * i % 11]) for i in range(140)]
    (tmp_path / "in").mkdir()
    for name, ending, own in (("a.csv", "\n", rows[:90]), ("b.csv", "\r\n", rows[90:]), ("c.csv", "\n", [])):
        with (tmp_path / "in" / name).open("w", newline="") as out:
            csv.writer(out, lineterminator=ending, quoting=csv.QUOTE_ALL if name == "b.csv" else csv.QUOTE_MINIMAL).writerows(own)
    found = [r.record for r in records_of(spark, tmp_path / "in", split).collect()]
    parsed = [tuple(next(csv.reader([record], strict=True))) if "\n" not in record else tuple(list(csv.reader(record.splitlines(keepends=True)))[0]) for record in found]
    assert len(found) == len(rows)
    assert sorted(p[2] for p in parsed) == sorted(r[2] for r in rows)
    joined = Counter(found)
    expected = Counter()
    for own, quoting in ((rows[:90], csv.QUOTE_MINIMAL), (rows[90:], csv.QUOTE_ALL)):
        for row in own:
            text = io.StringIO()
            csv.writer(text, lineterminator="", quoting=quoting).writerow(row)
            expected[text.getvalue()] += 1
    assert joined == expected


def test_unclosed_and_empty(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,2\n\n3,"open\nmore\nand more')
    assert sorted(r.record for r in records_of(spark, tmp_path / "a.csv", 9).collect()) == ["", "1,2", '3,"open\nmore\nand more']
    (tmp_path / "b.csv").write_text("")
    assert records_of(spark, tmp_path / "b.csv", 9).collect() == []
    (tmp_path / "c.csv").write_text('"' + "x\n" * 500)
    with pytest.raises(Exception, match="never closed"):
        records_of(spark, tmp_path / "c.csv", 1 << 20, longest=100).collect()


def test_quoted_csv(spark, tmp_path):
    rows = [("1", "a\nb", None), ("2", "", 'q"\n"'), ("3", None, "x")]
    df = spark.createDataFrame(rows, "n string, t string, u string")
    sinks.write_csv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, sources.read_quoted_csv(spark, str(tmp_path / "t"), "n string, t string, u string").collect())) == rows


def test_many_cuts_to_a_task(spark, tmp_path):
    """A file cut every 64 kB is read by as many tasks as would read it whole, with the same records."""
    n = 40_000
    tables = {
        "lineitem": f"""select id l_orderkey, 50L l_partkey, 1L l_suppkey, 1 l_linenumber, 1D l_quantity, 'N' l_returnflag, 'O' l_linestatus,
            timestamp_ntz'2024-01-09' l_shipdate from range({n})""",
        "orders": f"select id o_orderkey, 1L o_custkey, make_timestamp_ntz(2024, cast(1 + id % 12 as int), 3, 0, 0, 0) o_orderdate from range({n})",
        "customer": "select 1L c_custkey, 1 c_nationkey",
        "supplier": "select 1L s_suppkey, 1 s_nationkey",
        "nation": "select 1 n_nationkey, 'PERU' n_name",
        "part": "select 50L p_partkey, 'B1' p_brand",
    }
    for name, rows in tables.items():
        spark.sql(rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = QUERIES["scan_quoted_breaks"](spark, str(tmp_path))
    notes = dict(found.groupBy("note").count().collect())
    month = Counter("x" if i % 101 == 1 else "" if i % 101 == 2 else "month" if i % 101 == 3 else str(1 + i % 12) for i in range(n))
    broken = {"7": "from PERU\nPERU", "3": 'from PERU"\n\n, "PERU', "5": 'from PERU to PERU\n"'}
    expected = {broken[m]: month.pop(m) for m in broken}
    assert notes == expected | {"from PERU to PERU": sum(month.values())}
    assert len(found.inputFiles()) <= 8 + 1  # a file for each task, and one for the records that cross cuts


def test_cuts_inside_quotes_are_not_sent_with_each_task(spark, tmp_path, monkeypatch):
    """They are many in a large file; a broadcast is read once by each worker."""
    told, pieces = [], records._pieces

    def spy(inside, *rest):
        told.append(inside)
        return pieces(inside, *rest)

    monkeypatch.setattr(records, "_pieces", spy)
    (tmp_path / "a.csv").write_text('1,"a\nb"\n' * 200)
    assert {r.record for r in records_of(spark, tmp_path / "a.csv", 16).collect()} == {'1,"a\nb"'}
    assert told and all(isinstance(inside, Broadcast) and list(map(len, inside.value.values()))[0] > 50 for inside in told)


# ---- distinct rows by digest


@pytest.mark.parametrize("most_repeated", [1_000_000, 2])
def test_distinct_by_digest(spark, monkeypatch, most_repeated):
    rows = [(i % 50, None if i % 3 == 0 else f"r{i % 40}", float(i % 2)) for i in range(900)] + [(1000 + i, None, None) for i in range(300)]
    rows += [(None, "a", None), (None, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(5)
    assert Counter(map(tuple, ops.distinct_by_digest(df, most_repeated).collect())) == Counter(set(rows))
    assert ops.distinct_by_digest(df.limit(0)).collect() == []


def test_rows_of_one_digest_are_told_apart(spark, monkeypatch):
    """A hash skips nulls, so these two rows share a digest."""
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None), ("b", "c")], "x string, y string")
    assert df.selectExpr("xxhash64(x, y) h").distinct().count() == 2
    assert Counter(map(tuple, ops.distinct_by_digest(df).collect())) == Counter([("a", None), (None, "a"), ("b", "c")])


def test_unique_rows_are_not_shuffled(spark):
    df = spark.range(1000).selectExpr("id", "repeat(cast(id as string), 9) t").union(spark.range(5).selectExpr("id", "repeat(cast(id as string), 9) t"))
    plan = ops.distinct_by_digest(df).groupBy().agg(F.sum("id"))._jdf.queryExecution().executedPlan().toString()
    anti, semi = plan.split("LeftSemi")[0], plan.split("LeftSemi")[-1]
    assert "BroadcastHashJoin" in plan and "LeftAnti" in anti and "SortMergeJoin" not in plan
    # The branch of the unique rows reads the digest and the column asked for, and is added up before any exchange.
    assert plan.count("Exchange hashpartitioning") == 1 and "ReadSchema: struct<id:bigint,_digest:bigint>" in plan, semi


def test_command_line(tmp_path, capsys, monkeypatch):
    from skyledger import __main__ as command

    write_lines(tmp_path / "1.csv", LINES[:6])
    write_lines(tmp_path / "2.csv", LINES[6:])
    monkeypatch.setattr(command, "build_session", lambda name: None)
    calls = []
    monkeypatch.setattr(command, "run_job", lambda spark, *a: calls.append(("run", *a)) or {"lines": 7, "bad month": 0})
    monkeypatch.setattr(command, "merge_job", lambda spark, *a: calls.append(("merge", *a)))
    monkeypatch.setattr(command, "state_job", lambda spark, *a: calls.append(("state", *a)))
    monkeypatch.setattr(command, "build_session", lambda name: type("Session", (), {"stop": lambda self: None})())
    paths = ["--input_path", "in", "--output_path", "out"]
    command.main(["ranking_sql", *paths, "--rejects_path", "bad"])
    command.main(["route_stats_arr", *paths, "--state_path", "st", "--batch", "d1"])
    assert calls == [
        ("run", "ranking_sql", "in", "out", None, None, "bad"),
        ("merge", "route_stats_arr", "in", "st", "d1"),
        ("state", "route_stats_arr", "st", "out", None),
    ]
    assert capsys.readouterr().out == "lines: 7\n"
    for wrong in (["ranking_sql", *paths, "--state_path", "s", "--batch", "b"], ["route_stats_arr", *paths, "--batch", "b"]):
        with pytest.raises(SystemExit):
            command.main(wrong)
