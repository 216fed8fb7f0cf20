"""The plans are the ones meant: one exchange, no Python, skew handled, little read."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from careloom.operators import codes, dedup, orphans, patterns, profile, repairs
from careloom.operators.history import merge_history
from careloom.operators.lookup import lookup, zip_to_ruca
from careloom.operators.repairs import invalid_to_null
from careloom.operators.result import TOUCHED
from careloom.plans import chains
from careloom.sources.reference import stage_vocabulary
from tests.conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df):
    """The plan as it ran."""
    out = df.agg(F.sum(F.hash(*[F.col(c) for c in df.columns])).alias("h"))
    out.collect()
    return plan(out).split("Initial Plan")[0]


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(entry_points.queries()[name](spark, SMALL))
    assert not re.search("EvalPython|InPandas|CartesianProduct|BroadcastNestedLoop|Scan ExistingRDD.*python", text)


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    text = plan(dedup.keep_first(df, ["l_orderkey"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_profiles_shuffle_once(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet").withColumnRenamed("o_orderdate", "ORDER_DATE")
    assert plan(profile.monthly_counts(df, ordered=False)).count("Exchange hashpartitioning") == 1
    assert plan(profile.value_counts(df, ["o_orderstatus", "o_orderpriority"])).count("Exchange hashpartitioning") == 1
    ran = profile.value_profile(df)
    ran.collect()
    assert "ReusedExchange" in plan(ran) or plan(ran).split("Initial Plan")[0].count("FileScan") == 1


def test_only_needed_columns_are_read(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    text = plan(orphans.nullify_orphans(orders, orders.where("o_orderstatus = 'F'"), "o_orderkey").report)
    assert "o_totalprice" not in text
    assert "EqualTo(o_orderstatus,F)" in text


def test_dimension_joins_are_broadcast_by_size(spark):
    line, part = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("lineitem", "part"))
    assert "BroadcastHashJoin" in plan(lookup(line, part, {"l_partkey": "p_partkey"}, {"brand": "p_brand"}))


def test_small_domains_of_a_large_vocabulary_are_broadcast(spark, tmp_path):
    domain = F.when(F.col("id") < 40, "Visit").when(F.col("id") < 44, F.lit(None)).otherwise("Drug")
    one = spark.range(200_000).select(F.col("id").cast("string").alias("concept_id"), domain.alias("domain_id"), F.sha2(F.col("id").cast("string"), 256).alias("concept_name"))
    one.write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    staged = stage_vocabulary(plain, "vocabulary_by_domain")
    visits = spark.range(1_000_000).select((F.col("id") % 50).cast("string").alias("visit"))
    joined = [lookup(visits, c, {"visit": "concept_id"}, {"name": "concept_name"}, where="domain_id = 'Visit'") for c in (plain, staged)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    try:
        assert ["BroadcastHashJoin" in plan(j.select("*")) for j in joined] == [False, True]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert staged.columns == plain.columns and staged.exceptAll(plain).isEmpty() and plain.exceptAll(staged).isEmpty()
    assert joined[0].groupBy("name").count().exceptAll(joined[1].groupBy("name").count()).isEmpty()


def test_a_settled_chain_runs_each_repair_once(spark, tmp_path):
    ids = spark.range(60).select(F.col("id").cast("string").alias("n"))
    rows = ids.selectExpr("n AS PATID", "n AS ENCOUNTERID", "n AS PROVIDERID", "'d' AS ADMIT_DATE", "'t' AS ENC_TYPE")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    tables = {
        "DEMOGRAPHIC": ids.where("n % 7 > 0").select(F.col("n").alias("PATID")),
        "ENCOUNTER": ids.where("n % 5 > 0").selectExpr("n AS ENCOUNTERID", "'2024' AS ADMIT_DATE", "'IP' AS ENC_TYPE"),
        "PROVIDER": ids.where("n % 3 > 0").select(F.col("n").alias("PROVIDERID")),
    }

    written = {}

    def settle(df, name):
        written[name] = plan(df)
        df.write.partitionBy(TOUCHED).parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))

    lazy, once = (chains.run_chain(rows, chains.CHAINS["DIAGNOSIS"], chains.Context(tables), s) for s in (None, settle))
    assert lazy[0].exceptAll(once[0]).isEmpty() and once[0].exceptAll(lazy[0]).isEmpty()
    assert len(written) == len(once[1]) == 4
    assert [len(re.findall(r"Join \[", p)) for p in written.values()] == [1] * 4
    for name, result in once[1].items():
        assert "Join" not in plan(result.good) + plan(result.rejects)
        # rejects and report read the folder of the touched rows only
        assert re.search(r"PartitionFilters: \[.*__touched", plan(result.rejects))
        for part in ("rejects", "report"):
            touched, before = getattr(result, part), getattr(lazy[1][name], part)
            if touched is not None:
                assert touched.exceptAll(before).isEmpty() and before.exceptAll(touched).isEmpty()


def test_a_hot_gram_is_split(big_cluster, monkeypatch):
    """A third of the texts hold the listed text's only gram, another third one and the same text."""
    monkeypatch.setattr(patterns, "MOST_TRIED", 0)
    i = F.col("id")
    text = F.when(i % 3 == 0, F.concat(F.lit("abcd"), i.cast("string"))).when(i % 3 == 1, F.lit("same text")).otherwise(i.cast("string"))
    df = big_cluster.range(0, 90_000, 1, 8).select(text.alias("T"), i.alias("V"))
    listed = big_cluster.createDataFrame([("ABCD",), ("me TE",), ("nowhere",)], "p STRING")
    result = repairs.remove_patterns(df, "T", listed)
    assert result.good.count() == 30_000 and result.rejects.count() == 60_000
    assert "skew=true" in run_plan(result.good)


def broadcasts(text):
    """What is computed for each broadcast of a plan that ran, from its last shuffles on."""
    lines = text.splitlines()
    depth = [len(re.match(r"[\s:|+\-*]*", x).group()) for x in lines]
    for at in (k for k, x in enumerate(lines) if "BroadcastExchange" in x):
        kept, top = [], None
        for k in range(at + 1, len(lines)):
            if depth[k] <= depth[at]:
                break
            top = top if top is not None and depth[k] > top else None
            if top is None:
                kept.append(lines[k])
                top = depth[k] if "ShuffleQueryStage" in lines[k] else None
        yield "\n".join(kept)


def long_list(spark):
    """4,000 texts of 14 letters a and b, in which 500 of 2,000 listed ones occur; all runs of four letters are common."""

    def text(number):
        return F.translate(F.lpad(F.bin(number), 14, "0"), "01", "ab")

    return spark.range(4_000).select(text(F.col("id")).alias("T")), spark.range(0, 16_000, 8).select(text(F.col("id")).alias("p"))


def test_places_of_texts_are_not_sent_to_all_tasks(spark):
    """Spark takes what is exploded to be as small as the table it comes from."""
    texts, listed = long_list(spark)
    result = repairs.remove_patterns(texts, "T", listed)
    text = run_plan(result.good)
    assert "Generate" in text and list(broadcasts(text))
    assert not any("Generate" in below for below in broadcasts(text))


def test_texts_with_common_runs_are_not_paired(spark, monkeypatch):
    """No join makes more rows than the texts have letters."""
    # then the rows of a join are the pairs that would be tried
    monkeypatch.setattr(patterns.F, "rlike", lambda text, p: F.lit(True))
    texts, listed = long_list(spark)
    rejects = repairs.remove_patterns(texts, "T", listed).rejects
    found = rejects.collect()
    made, left = [], [rejects._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.nodeName()
        if "Join" in name:
            made.append(node.metrics().get("numOutputRows").get().value())
        inner = node.executedPlan() if name == "AdaptiveSparkPlan" else node.plan() if "QueryStage" in name else None
        children = node.children()
        left += [inner] if inner is not None else [children.apply(k) for k in range(children.size())]
    assert made and max(made) <= 4_000 * 14
    assert len(found) == 500


@pytest.mark.parametrize("operator", ["valid codes", "zip", "codes"])
def test_a_hot_key_is_split_in_lookups_of_lists(big_cluster, operator, monkeypatch):
    df, up = hot(big_cluster), parents(big_cluster)
    monkeypatch.setattr(codes, "BROADCAST_BYTES", 100)
    if operator == "zip":
        made = zip_to_ruca(df, up.select(F.col("K").alias("ZIPCode"), F.lit("1").alias("PrimaryRUCA")), "K")
    elif operator == "codes":
        entries = up.select(F.lit("T").alias("table"), F.lit("K").alias("field"), F.col("K").alias("source_value"), F.lit("x").alias("target_value"))
        made = codes.map_codes(df, entries, "T", ["K"], "strict")
    else:
        made = invalid_to_null(df, "K", up, "K").good
    assert "skew=true" in run_plan(made)


@pytest.fixture
def big_cluster(spark):
    """Thresholds scaled down so that small data takes the plans of large data."""
    scaled = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in scaled}
    for k, v in scaled.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=300_000):
    """A third of the rows on one key, a third without a key."""
    i = F.col("id")
    key = F.when(i % 3 == 0, F.lit("7")).when(i % 3 == 2, (i % 20000).cast("string"))
    return spark.range(0, n, 1, 8).select(key.alias("K"), i.cast("string").alias("V"), F.lit("x").alias("A"))


def parents(spark):
    one = spark.range(0, 15000, 1, 4).select(F.col("id").cast("string").alias("K"), F.lit("p").alias("A"))
    return one.unionAll(one)


@pytest.mark.parametrize("part", ["good", "rejects"])
@pytest.mark.parametrize("fix", ["drop", "nullify", "replicate"])
def test_a_hot_key_is_split(big_cluster, fix, part):
    df, up = hot(big_cluster), parents(big_cluster)
    result = {
        "drop": lambda: orphans.drop_orphans(df, up, "K"),
        "nullify": lambda: orphans.nullify_orphans(df, up, "K"),
        "replicate": lambda: orphans.replicate(df, up, "K", ["A"]),
    }[fix]()
    assert "skew=true" in run_plan(getattr(result, part))


def test_a_hot_key_is_split_in_grouped_lookups(big_cluster):
    df, up = hot(big_cluster), parents(big_cluster)
    assert "skew=true" in run_plan(lookup(df, up, {"K": "K"}, {"got": "A"}, last_by=["A"]))


def test_a_hot_patient_is_split_in_histories(big_cluster):
    old = hot(big_cluster).select(
        F.col("K").alias("PATID"), F.col("V").alias("ADDRESS_ZIP5"), F.lit("2001-01-01").alias("ADDRESS_PERIOD_START"),
        F.lit(None).cast("string").alias("ADDRESS_PERIOD_END"),
    )
    new = old.where("PATID = '7'").withColumn("ADDRESS_PERIOD_START", F.lit("2002-01-01"))
    merged = merge_history(old, new)
    assert "skew=true" in run_plan(merged)
    assert merged.count() == old.count()
    assert merged.where("ADDRESS_PERIOD_END IS NOT NULL").count() == new.count()


def test_report_cap_is_applied_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    text = plan(profile.top_profile(df, ["o_orderpriority", "o_totalprice"], 100))
    assert text.count("WindowGroupLimit") >= 4
    assert "Partial" in text
