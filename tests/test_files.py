"""Readers, writers and file-to-file jobs."""

from __future__ import annotations

import json
import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from skyledger import JOBS, RANKING_PRESETS, ROUTE_PRESETS, ranking_preset, read_flights, route_preset, run_job
from skyledger.__main__ import first_lines
from skyledger.functions.text import try_number
from skyledger.operators import Fields, join_airport_mean, nest, operated_airport_means, unnest
from skyledger.plans import read_for
from skyledger.schema import FLIGHT_COLUMNS, PAIR_KEYS, RANKING_LIST, RANKING_REPORT, ROUTE_LIST, SOURCE_POSITIONS
from skyledger.session import release_scratch, scratch_folder, write_and_reread
from skyledger.sinks import write_airport_means, write_csv
from skyledger.sources import DIALECT, read_airport_means, resolve_columns


def source_line(**values):
    fields = [""] * 35
    for name, value in values.items():
        fields[SOURCE_POSITIONS[name]] = value
    fields[8] = '"New York, NY"'
    return ",".join(fields)


def full_header():
    names = [f"other_{i}" for i in range(35)]
    for name, position in SOURCE_POSITIONS.items():
        names[position] = name
    return ",".join(names)


def line(month="1", carrier="AA", origin="JFK", dest="LAX", dep="5.0", arr="3.0", cancelled="0"):
    return source_line(
        month=month, op_unique_carrier=carrier, origin=origin, dest=dest,
        dep_delay=dep, arr_delay=arr, cancelled=cancelled,
    )


FLIGHT = (1, "AA", "JFK", "LAX", 5.0, 3.0, 0.0)


def flights_of(spark, path, **options):
    return [tuple(r) for r in read_flights(spark, str(path), **options).collect()]


def test_wide_file_by_name(spark, tmp_path):
    (tmp_path / "f.csv").write_text("\n".join([full_header(), line(), ""]))
    assert flights_of(spark, tmp_path / "f.csv") == [FLIGHT]


def test_header_in_any_case_and_order(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        " Cancelled ,ORIGIN,dest,Month,Op_Unique_Carrier,ARR_DELAY,dep_delay\n0,JFK,LAX,1,AA,3,5\n"
    )
    assert flights_of(spark, tmp_path / "f.csv") == [FLIGHT]


def test_file_without_header_uses_the_source_positions(spark, tmp_path):
    (tmp_path / "f.csv").write_text("\n".join([line(), line(carrier="BB")]) + "\n")
    assert sorted(flights_of(spark, tmp_path / "f.csv")) == [FLIGHT, (1, "BB", *FLIGHT[2:])]


def test_file_cut_in_parts_loses_no_line(spark, tmp_path):
    (tmp_path / "part-1.csv").write_text("\n".join([full_header()] + [line()] * 50) + "\n")
    (tmp_path / "part-2.csv").write_text("\n".join([line()] * 30) + "\n")
    assert flights_of(spark, tmp_path) == [FLIGHT] * 80


def test_names_may_be_given(spark, tmp_path):
    (tmp_path / "f.csv").write_text("JFK,LAX,1,AA,3,5,0\n" * 3)
    names = ["origin", "dest", "month", "op_unique_carrier", "arr_delay", "dep_delay", "cancelled"]
    assert flights_of(spark, tmp_path / "f.csv", header=names) == [FLIGHT] * 3


def test_short_and_bad_lines_are_dropped(spark, tmp_path):
    bad = [
        line()[:40],
        line(month="x"),
        line(month=""),
        line(cancelled="maybe"),
        line(arr="late"),
        line(origin=" \t"),
        full_header(),
        "",
    ]
    (tmp_path / "f.csv").write_text("\n".join([full_header(), *bad, line()]) + "\n")
    assert flights_of(spark, tmp_path / "f.csv") == [FLIGHT]


def test_ranking_needs_no_destination(spark, tmp_path):
    (tmp_path / "f.csv").write_text("\n".join([full_header(), line(dest="")]) + "\n")
    assert flights_of(spark, tmp_path / "f.csv") == []
    assert len(flights_of(spark, tmp_path / "f.csv", fields=Fields(PAIR_KEYS))) == 1


def test_unusable_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("origin,dest\nJFK,LAX\n")
    (tmp_path / "b.csv").write_text("1,2,3\n4,5,6\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        read_flights(spark, str(tmp_path / "a.csv"))
    with pytest.raises(ValueError, match="cannot be located"):
        read_flights(spark, str(tmp_path / "b.csv"))


def test_scan_reads_only_the_flight_columns(spark, tmp_path):
    (tmp_path / "f.csv").write_text("\n".join([full_header(), line()]) + "\n")
    flights = read_flights(spark, str(tmp_path / "f.csv"))
    plan = ranking_preset(flights, "ranking_sql")._jdf.queryExecution().executedPlan().toString()
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schema.split(",")) == len(FLIGHT_COLUMNS)


def test_rest_tells_rows_apart(spark):
    wide = spark.createDataFrame(
        [("a,b", "c"), ("a", "b,c"), ('a"', "b"), ("a", '"b'), (None, ""), ("", None)], "u string, v string"
    )
    flights = wide.selectExpr("u", "v", *(f"'' AS {c}" for c in FLIGHT_COLUMNS))
    rests = [r.rest for r in resolve_columns(flights, keep_rest=True).collect()]
    assert len(set(rests)) == 6


def test_whole_row_dedupe_looks_at_every_column(spark, tmp_path):
    other = line().replace("New York", "Newark")
    (tmp_path / "f.csv").write_text("\n".join([full_header(), line(), line(), line(cancelled="0.0"), other]) + "\n")
    run_job(spark, "ranking_zero_dedupe", str(tmp_path / "f.csv"), str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["JFK\t1;AA;2;5.0;3.0;0.0;0.0"]


def test_side_table(spark, tmp_path, hand_csv):
    path = str(tmp_path / "means")
    means = operated_airport_means(read_flights(spark, hand_csv))
    write_airport_means(means, path)
    assert sorted(map(tuple, read_airport_means(spark, path).collect())) == [("BOS", 7.0), ("JFK", 4.4)]
    with pytest.raises(AnalysisException):
        read_airport_means(spark, str(tmp_path / "nothing"))
    assert read_airport_means(spark, str(tmp_path / "nothing"), missing_ok=True).count() == 0


def test_ranking_with_saved_means_equals_ranking_without(spark, tmp_path, hand_csv):
    for job, ranking in (("airport_mean", "ranking_zero_excl"), ("airport_mean_unrounded", "ranking_zero_incl")):
        means, one, two = (str(tmp_path / f"{ranking}-{part}") for part in ("means", "one", "two"))
        run_job(spark, job, hand_csv, means)
        run_job(spark, ranking, hand_csv, one)
        run_job(spark, ranking, hand_csv, two, means_path=means)
        assert spark.read.text(one).collect() == spark.read.text(two).collect()


@pytest.mark.parametrize("name", RANKING_PRESETS)
def test_ranking_jobs(spark, tmp_path, name, hand_csv):
    expected = JOBS[name].report(read_for(spark, JOBS[name], hand_csv))
    run_job(spark, name, hand_csv, str(tmp_path / "nested"), fmt="nested")
    nested = spark.read.schema(nest(expected, "Aeroporto", RANKING_LIST).schema).json(str(tmp_path / "nested"))
    assert nested.count() == 2
    back = unnest(nested, "Aeroporto", RANKING_LIST)
    assert {tuple(r) for r in back.select(*RANKING_REPORT).collect()} == {tuple(r) for r in expected.collect()}
    places = [(r.Posizione_Classifica, r.Compagnia) for r in back.where("Aeroporto = 'JFK'").orderBy("index").collect()]
    assert places == sorted(places)

    run_job(spark, name, hand_csv, str(tmp_path / "text"), fmt="text")
    lines = [r.value for r in spark.read.text(str(tmp_path / "text")).collect()]
    assert len(lines) == 5
    number = r"(-?\d+\.\d+|NULL)"
    assert all(re.fullmatch(rf"\w+\t\d+;[\w, ]+;\d+(;{number}){{4}}", text) for text in lines)


def test_route_text(spark, tmp_path, hand_csv):
    run_job(spark, "route_stats_arr", hand_csv, str(tmp_path / "text"), fmt="text")
    lines = {r.value for r in spark.read.text(str(tmp_path / "text")).collect()}
    assert "AA\tJFK -> LAX;4;-10.0;5.0;0.0;0.25;[1,2,10]" in lines
    assert "BB\tJFK -> LAX;2;NULL;NULL;NULL;0.5;[3]" in lines


def test_route_json_text(spark, tmp_path, hand_csv):
    run_job(spark, "route_stats_arr", hand_csv, str(tmp_path / "text"), fmt="json_text")
    records = [r.value.split("\t") for r in spark.read.text(str(tmp_path / "text")).collect()]
    parsed = {(carrier, json.loads(text)["Tratta"]): json.loads(text) for carrier, text in records}
    assert parsed["AA", "JFK -> LAX"] == {
        "Tratta": "JFK -> LAX", "Voli": 4, "Min": -10.0, "Max": 5.0, "Medio": 0.0, "Cancellazioni": 0.25,
        "Mesi": [1, 2, 10],
    }
    assert parsed["CC", "JFK -> SFO"]["Medio"] is None


@pytest.mark.parametrize("name", [n for n, r in ROUTE_PRESETS.items() if not r.text_months])
def test_route_nested(spark, tmp_path, name, hand_csv):
    expected = route_preset(read_flights(spark, hand_csv), name)
    run_job(spark, name, hand_csv, str(tmp_path / "nested"))
    nested = spark.read.schema(nest(expected, "Compagnia", ROUTE_LIST).schema).json(str(tmp_path / "nested"))
    assert {r.Compagnia: len(r[ROUTE_LIST]) for r in nested.collect()} == {
        "AA": 1, "BB": 2, "CC": 1, "DD": 1, "EE, Inc": 1,
    }
    back = unnest(nested, "Compagnia", ROUTE_LIST).select(*expected.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, expected.collect()))


def test_route_csv_replaces_the_output(spark, tmp_path, hand_csv):
    out = str(tmp_path / "csv")
    for _ in range(2):
        run_job(spark, "route_stats_dep_flat", hand_csv, out)
    written = spark.read.options(header=True, escape='"').csv(out)
    assert written.count() == 6
    assert {(r.Compagnia, r.Mesi) for r in written.collect()} >= {("AA", "1,10,2"), ("EE, Inc", "6")}


def test_job_refuses_what_it_cannot_do(spark, tmp_path, hand_csv):
    with pytest.raises(ValueError, match="no airport means"):
        run_job(spark, "route_stats_arr", hand_csv, str(tmp_path / "x"), means_path=hand_csv)
    with pytest.raises(KeyError):
        run_job(spark, "route_stats_arr", hand_csv, str(tmp_path / "x"), fmt="tsv")


def test_command_line(tmp_path, hand_csv):
    root = Path(__file__).resolve().parent.parent
    out = tmp_path / "report"
    command = [sys.executable, str(root / "run.py"), "ranking_zero_excl", "--preview", "2"]
    command += ["--input_path", hand_csv, "--output_path", str(out)]
    done = subprocess.run(command, check=True, capture_output=True, timeout=300, cwd=root, text=True)
    assert len([text for text in done.stdout.splitlines() if "\t" in text]) == 2
    lines = [text for part in sorted(out.glob("part-*")) for text in part.read_text().splitlines()]
    assert lines[:3] == [
        "BOS\t1;DD;2;5.0;2.0;0.0;0.0",
        "BOS\t2;EE, Inc;1;7.0;2.0;0.0;2.0",
        "JFK\t1;CC;1;0.0;0.0;1.0;-4.4",
    ]


def test_scratch_tables_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(spark, "t").startswith(shared)
    assert scratch_folder(spark, "t") != scratch_folder(spark, "t")
    assert write_and_reread(spark.range(5), "t").count() == 5


def test_every_job_is_covered():
    assert set(JOBS) == {*ROUTE_PRESETS, *RANKING_PRESETS, "airport_mean", "airport_mean_unrounded"}


# Six flights of one pair, with a bad or missing field each but the first, and what each job makes of them.
SIX = """month,op_unique_carrier,origin,dest,dep_delay,arr_delay,cancelled
1,AA,JFK,LAX,10,5,0
,AA,JFK,LAX,20,5,0
x,AA,JFK,LAX,20,5,0
2,AA,JFK,LAX,30,5,
3,AA,JFK,LAX,late,late,1
4,AA,JFK,LAX,4,1;5,0
"""


@pytest.fixture
def six(tmp_path):
    (tmp_path / "six.csv").write_text(SIX)
    return str(tmp_path / "six.csv")


def report(spark, name, path):
    return [tuple(r) for r in JOBS[name].report(read_for(spark, JOBS[name], path)).collect()]


def test_a_report_loses_no_flight_over_a_field_it_does_not_read(spark, six):
    assert report(spark, "airport_mean", six) == [("JFK", 16.8)]
    assert report(spark, "ranking_zero_excl", six) == [("JFK", 1, "AA", 5, 20.0, 5.0, 0.2, 3.2)]
    # delays of cancelled flights count there, so "late" is a bad field
    assert report(spark, "ranking_zero_incl", six) == [("JFK", 1, "AA", 4, 20.0, 5.0, 0.0, 3.2)]
    # SQL: a missing flag is NULL, so that flight counts without delays
    assert report(spark, "ranking_sql", six) == [("JFK", 1, "AA", 5, 16.67, 5.0, 0.25, 0.0)]
    assert report(spark, "route_stats_arr", six) == [("AA", "JFK -> LAX", 2, 5.0, 5.0, 5.0, 0.5, [1, 3])]
    assert report(spark, "route_stats_dep_flat", six) == [("AA", "JFK -> LAX", 5, 4.0, 20.0, 11.33, 0.25, "1,2,3,4")]


def test_ranking_with_saved_means_equals_ranking_without_on_bad_fields(spark, tmp_path, six):
    run_job(spark, "airport_mean", six, str(tmp_path / "means"))
    run_job(spark, "ranking_zero_excl", six, str(tmp_path / "out"), means_path=str(tmp_path / "means"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["JFK\t1;AA;5;20.0;5.0;0.2;3.2"]


@pytest.mark.parametrize(
    "name, unread",
    [
        ("ranking_zero_excl", {"month", "dest"}),
        ("ranking_sql", {"month", "dest"}),
        ("airport_mean", {"month", "dest", "arr_delay", "op_unique_carrier"}),
        ("route_stats_arr", {"dep_delay"}),
    ],
)
def test_scan_reads_only_what_the_report_reads(spark, tmp_path, name, unread):
    names = sorted(FLIGHT_COLUMNS)
    (tmp_path / "f.csv").write_text(",".join(names) + "\nx,1,1,1,1,1,1\n")
    plan = JOBS[name].report(read_for(spark, JOBS[name], str(tmp_path / "f.csv")))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan._jdf.queryExecution().executedPlan().toString())
    read = {names[int(i)] for i in re.findall(r"_c(\d+):", schema)}
    assert read == set(FLIGHT_COLUMNS) - unread


def test_files_of_different_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("month,op_unique_carrier,origin,dest,dep_delay,arr_delay,cancelled\n1,AA,JFK,LAX,5,3,0\n")
    (tmp_path / "b.csv").write_text("month,op_unique_carrier,dest,origin,arr_delay,dep_delay,cancelled\n1,AA,LAX,JFK,3,5,0\n")
    assert flights_of(spark, tmp_path) == [FLIGHT] * 2
    (tmp_path / "c.csv").write_text("1,AA,JFK,LAX,5,3,0\n")
    with pytest.raises(ValueError, match="has no header"):
        flights_of(spark, tmp_path)


def test_compressed_files_have_headers_too(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write("origin,dest,month,op_unique_carrier,arr_delay,dep_delay,cancelled\nJFK,LAX,1,AA,3,5,0\n")
    assert flights_of(spark, tmp_path / "a.csv.gz") == [FLIGHT]


def test_side_table_with_repeated_airports(spark):
    pairs = spark.createDataFrame([("JFK", "AA"), ("BOS", "BB")], "origin string, op_unique_carrier string")
    same = spark.createDataFrame([("JFK", 1.0), ("JFK", 1.0)], "origin string, airport_mean double")
    assert sorted(r.airport_mean for r in join_airport_mean(pairs, same).collect()) == [0.0, 1.0]
    other = spark.createDataFrame([("JFK", 1.0), ("JFK", 2.0)], "origin string, airport_mean double")
    with pytest.raises(Exception, match="different means for airport JFK"):
        join_airport_mean(pairs, other).collect()


def test_csv_keeps_outer_blanks_and_tells_null_from_empty(spark, tmp_path):
    rows = [("  a\t", None, ""), ("", " ", 'q"'), (None, "x,y", "\t")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    write_csv(df, str(tmp_path / "out"))
    back = spark.read.options(header=True, **DIALECT).schema(df.schema).csv(str(tmp_path / "out"))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_any_mean_survives_the_side_table(spark, tmp_path):
    import random
    import struct

    r = random.Random(4)
    values = [struct.unpack("<d", r.randbytes(8))[0] for _ in range(10_000)]
    values = [v for v in values if v == v and abs(v) != float("inf")] + [5e-324, 1.7976931348623157e308, 0.012345678901234567, 1e-20]
    means = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "origin string, airport_mean double")
    write_airport_means(means, str(tmp_path / "means"))
    back = {r.origin: r.airport_mean for r in read_airport_means(spark, str(tmp_path / "means")).collect()}
    assert all(back[str(i)] == v for i, v in enumerate(values))


def test_dedupe_compares_values(spark, tmp_path):
    lines = [full_header(), line(), line(), line(dep="5"), line().replace("New York", "Newark")]
    lines[2] = lines[2].replace(",,", ",7,", 1)
    lines += [lines[2].replace(",7,", ",7.0,", 1)]
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    assert report(spark, "ranking_zero_dedupe", str(tmp_path / "f.csv"))[0][3] == 3


def test_text_report_is_in_order_part_by_part(spark, tmp_path):
    rows = [f"{m % 12 + 1},C{m % 7},A{m % 50:02d},LAX,{m % 13},{m % 5},0" for m in range(3000)]
    (tmp_path / "f.csv").write_text(SIX.splitlines()[0] + "\n" + "\n".join(rows) + "\n")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        run_job(spark, "ranking_zero_excl", str(tmp_path / "f.csv"), str(tmp_path / "out"), fmt="text")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "out").glob("part-*"))]
    assert sum(1 for p in parts if p) > 2
    whole = [text for p in parts for text in p]
    keys = [(text.split("\t")[0], int(text.split("\t")[1].split(";")[0])) for text in whole]
    assert keys == sorted(keys) and len(keys) == 350
    assert first_lines(spark, str(tmp_path / "out"), 120) == whole[:120]


def test_numbers_are_plain_decimals(spark):
    texts = ["1", " -2.5 ", "+.5", "3.", "1e3", "10d", "5f", "NaN", "Infinity", "-inf", "0x1p3", "1_0", "", "None", None, "1,5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(try_number(df.t, "double")).collect()]
    assert found == [1.0, -2.5, 0.5, 3.0, 1000.0] + [None] * 11


def test_scratch_is_released(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir")
    written = scratch_folder(spark, "gone")
    spark.range(3).write.parquet(written)
    assert Path(written).exists() and written.startswith(before)
    release_scratch(spark)
    assert not Path(written).exists()
