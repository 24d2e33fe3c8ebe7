"""The shape of the physical plans."""

from __future__ import annotations

import re

import pytest

from skyledger.workloads.queries import QUERIES
from skyledger import RANKING_PRESETS, ROUTE_PRESETS, ranking_preset, read_flights, route_preset
from skyledger.workloads.voli import voli

FOLDER = "/root/testdata/sf0.001"
FLIGHT = (
    "month int, op_unique_carrier string, origin string, dest string, "
    "dep_delay double, arr_delay double, cancelled double"
)


@pytest.fixture()
def conf(spark):
    changed = {}

    def change(key, value):
        changed.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def flights(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("flights") / "table")
    spark.createDataFrame([], FLIGHT).write.parquet(path)
    return spark.read.schema(FLIGHT).parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (hashpartitioning\([^)]*\))", text)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_worker_and_no_product_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "MapPartitions"):
        assert node not in text, node


@pytest.mark.parametrize("name", [n for n, r in RANKING_PRESETS.items() if not r.dedupe])
def test_ranking_shuffles_pairs_then_airports(conf, flights, name):
    conf("spark.sql.adaptive.enabled", "false")
    text = plan(ranking_preset(flights, name))
    keys = [re.sub(r"#\d+", "", e) for e in exchanges(text)]
    assert len(keys) == 2
    assert keys[0].startswith("hashpartitioning(origin, ") and "op_unique_carrier" not in keys[0]
    assert keys[1].startswith("hashpartitioning(origin, op_unique_carrier")
    assert "partial_count" in text
    assert len(re.findall(r"\bSort \[", text)) == 1, "the windows share one sort"
    assert text.count("FileScan") == 1


def test_dedupe_meets_copies_before_the_shuffle(conf, flights):
    conf("spark.sql.adaptive.enabled", "false")
    text = plan(ranking_preset(flights, "ranking_zero_dedupe"))
    assert len(exchanges(text)) == 3 and text.count("FileScan") == 1
    assert re.search(r"HashAggregate\(keys=\[.*\], functions=\[\]", text[text.rindex("Exchange") :])


@pytest.mark.parametrize("name", ROUTE_PRESETS)
def test_route_stats_combine_rows_in_the_hash_aggregate_first(conf, flights, name):
    conf("spark.sql.adaptive.enabled", "false")
    text = plan(route_preset(flights, name))
    assert len(exchanges(text)) == 2 and text.count("FileScan") == 1
    scan_side = text[text.rindex("Exchange") :]
    assert "HashAggregate" in scan_side and "ObjectHashAggregate" not in scan_side


def test_unused_columns_are_not_read(flights):
    text = plan(ranking_preset(flights, "ranking_sql"))
    assert re.search(r"PushedFilters: \[[^]]*IsNotNull\(origin\)", text)
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "op_unique_carrier", "origin", "dep_delay", "arr_delay", "cancelled",
    }


@pytest.mark.parametrize("name", ["ranking_zero_excl", "route_stats_arr", "join_airport_mean", "join_side_table"])
def test_same_result_when_nothing_is_small_enough_to_broadcast(spark, conf, name):
    query = QUERIES[name]
    broadcast = sorted(map(str, query(spark, FOLDER).collect()))
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    shuffled = query(spark, FOLDER)
    assert "BroadcastHashJoin" not in plan(shuffled)
    assert sorted(map(str, shuffled.collect())) == broadcast


@pytest.mark.parametrize("name", [*ROUTE_PRESETS, *RANKING_PRESETS])
def test_generated_code_can_be_compiled(spark, conf, tmp_path, name):
    """The JVM leaves methods of more than 8000 bytes to its interpreter, many times slower."""
    conf("spark.sql.adaptive.enabled", "false")
    header = "month,op_unique_carrier,origin,dest,dep_delay,arr_delay,cancelled,other"
    (tmp_path / "f.csv").write_text(f"{header}\n1,AA,JFK,LAX,5.0,3.0,0,z\n")
    flights = read_flights(spark, str(tmp_path / "f.csv"), keep_rest=name == "ranking_zero_dedupe")
    report = route_preset if name in ROUTE_PRESETS else ranking_preset
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    code = getattr(debug, "MODULE$").codegenString(report(flights, name)._jdf.queryExecution().executedPlan())
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_no_fact_row_is_shuffled_by_a_nation(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(voli(spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_nation = [line for line in text.splitlines() if "Exchange hashpartitioning" in line and "nationkey" in line]
    assert len(by_nation) == 4 and text.count("SortMergeJoin") == 6  # both sides of supplier and customer with nation
    below = text[text.index("l_orderkey"):]
    assert not any("nationkey" in line for line in below.splitlines() if "hashpartitioning(l_" in line)
