"""Plans that have to hold at any size."""

import re

import pytest

from regua.analogues.queries import QUERIES

SF = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def explained(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_workers_cross_joins_or_one_task_windows(spark, name):
    plan = planned(QUERIES[name](spark, SF))
    assert not re.search(r"Python|Pandas|Arrow", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for line, below in zip(lines, lines[1:] + [""]):
        for window in re.findall(r"windowspecdefinition\(([^)]*)", line):
            # Numbering the few rows of a bounded sort is no such window.
            if "TakeOrderedAndProject" not in below:
                assert not re.match(r"\s*\S+ (ASC|DESC)", window), "window without partition"


def test_latest_year_prunes_partitions(spark):
    text = explained(QUERIES["q01_below_target_latest"](spark, SF))
    assert "TakeOrderedAndProject" in text
    assert re.search(r"PartitionFilters: \[isnotnull\(ano#\d+\), \(ano#\d+ = Subquery", text)
    assert "EqualTo(status_meta,ABAIXO_META)" in text


def test_history_filter_reaches_the_scan(spark):
    text = explained(QUERIES["q02_entity_history"](spark, SF))
    assert "EqualTo(id_municipio,217)" in text


@pytest.mark.parametrize(
    "name, sorts",
    [("q04_lowest_micro_rate", 1), ("q05_largest_gaps", 1), ("q11_official_vs_micro", 1),
     ("q12_best_worst", 2)],
)
def test_limits_are_bounded_sorts(spark, name, sorts):
    assert planned(QUERIES[name](spark, SF)).count("TakeOrderedAndProject") == sorts


def test_scan_reads_only_what_is_asked(spark):
    text = explained(QUERIES["parquet_scan_pushed_filter"](spark, SF))
    assert "EqualTo(o_orderstatus,F)" in text
    read = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {part.split(":")[0] for part in read.split(",")} == {
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"}


def test_distinct_count_shuffles_by_key_and_id(spark):
    """A large group is spread over its ids before it meets in one task."""
    plan = planned(QUERIES["rate_rollup"](spark, SF))
    first = re.findall(r"hashpartitioning\(([^)]*)\)", plan)[-1]
    assert "id_aluno" in first


def test_unique_ids_need_only_one_small_shuffle(spark):
    from regua.analogues import workspace
    from regua.operators.rollup import rate_rollup

    rolled = rate_rollup(workspace.silver_micro(spark, SF), ids_unique=True)
    plan = planned(rolled)
    assert plan.count("Exchange") == 1 and "partial_count(id_aluno" in plan


def test_gates_read_each_table_as_often_as_they_must(spark):
    """Unit records for ids and for all else, targets once, results once and as the reference."""
    from regua.analogues import workspace
    from regua.operators.quality import quality_report

    pupils = workspace.silver_micro(spark, SF)
    results, targets = workspace.silver_pair(spark, SF, "id_municipio")
    tree = quality_report(pupils, results, targets)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in tree.splitlines() if "Relation [" in line]
    assert len(scans) == 2 + 2 + 1
    assert sum("id_aluno" in line for line in scans) == 2
    assert sum("percentual_participacao" in line for line in scans) == 1


@pytest.fixture
def tuned(spark):
    """Set session options for one test."""
    before = {}

    def tune(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("_", ".")
            before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield tune
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_hot_key_is_split_in_the_target_join(spark, tuned):
    from pyspark.sql import functions as F

    from regua.operators.targets import attach_targets

    tuned(
        autoBroadcastJoinThreshold="-1",
        adaptive_advisoryPartitionSizeInBytes="64k",
        adaptive_skewJoin_skewedPartitionThresholdInBytes="128k",
        adaptive_skewJoin_skewedPartitionFactor="2",
    )
    hot = F.col("id") % 3 == 0
    city = F.when(hot, 1).otherwise(F.col("id") % 5000).cast("int")
    results = spark.range(0, 300000, 1, 16).select(
        F.lit(2024).alias("ano"),
        city.alias("id_municipio"),
        F.lit("Pública").alias("rede_descricao"),
        F.sha2(F.col("id").cast("string"), 256).alias("texto"),
    )
    targets = spark.range(5000).select(
        F.lit(2024).alias("ano"),
        F.col("id").cast("int").alias("id_municipio"),
        F.lit("Pública").alias("rede_descricao"),
        F.lit(60.0).alias("meta_alfabetizacao_2024"),
        F.lit(90.0).alias("percentual_participacao"),
    )
    joined = attach_targets(results, targets, "id_municipio", [2024])
    found = joined.agg(
        F.count("meta_alfabetizacao_2024").alias("matched"), F.max("texto")
    )
    assert found.collect()[0].matched == 300000
    assert "SortMergeJoin(skew=true)" in planned(found)
