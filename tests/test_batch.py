"""A batch from formatted tables to repaired ones, with its reports."""

import pytest
from pyspark.sql import functions as F

from careloom import session
from careloom.operators import repairs
from careloom.plans import batch, chains, flat, mapping
from careloom.plans.spec import run_job
from careloom.sources.files import read_stage
from careloom.sources.reference import code_map
from checks import views
from checks.registry import Inputs, Views
from tests.conftest import SMALL

TABLES = ("DEMOGRAPHIC", "PROVIDER", "ENCOUNTER", "DIAGNOSIS", "DEATH", "ENROLLMENT")


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    tables = Views(Inputs(spark, SMALL), views.FLAT)
    formatted = {t: run_job(flat.JOBS[t], tables) for t in TABLES}
    # half of the persons are unknown, so that repairs have something to do
    formatted["DEMOGRAPHIC"] = formatted["DEMOGRAPHIC"].where("SEX = 'F' OR SEX IS NULL")
    codes = code_map(spark, {("DEMOGRAPHIC", "SEX"): {"F": "FE"}, ("ENCOUNTER", "ENC_TYPE"): {"1-urgent": "ED"}})
    extra = {"DIAGNOSIS": [chains.step("remove_listed", codes="unwanted", column="DX"), chains.step("copy_when_null", field="DX_POA", other="PDX")]}
    job = batch.Batch(
        str(tmp_path_factory.mktemp("batch")), mapping.Site("ABC", "key", updated="2024-01-01 00:00:00"), codes,
        extra_fixes=extra, lists={"unwanted": spark.createDataFrame([("C1",), ("C2",)], "code STRING")},
    )
    return job, formatted, batch.run_batch(spark, job, formatted)


def test_tables_are_repaired_against_repaired_parents(spark, done):
    job, formatted, fixed = done
    assert set(fixed) == set(TABLES)
    people, visits = fixed["DEMOGRAPHIC"], fixed["ENCOUNTER"]
    for child in ("ENCOUNTER", "DIAGNOSIS", "DEATH", "ENROLLMENT"):
        assert fixed[child].count() > 0
        assert fixed[child].join(people, "PATID", "left_anti").count() == 0
    held = fixed["DIAGNOSIS"].where("ENCOUNTERID IS NOT NULL")
    assert held.join(visits, "ENCOUNTERID", "left_anti").count() == 0
    agree = held.alias("d").join(visits.alias("v"), "ENCOUNTERID").where("NOT (d.ADMIT_DATE <=> v.ADMIT_DATE AND d.ENC_TYPE <=> v.ENC_TYPE)")
    assert agree.count() == 0
    assert fixed["DIAGNOSIS"].where("DX IN ('C1', 'C2') OR DX_POA IS NULL").count() == 0


def test_duplicates_are_kept_apart(spark, done):
    job, formatted, fixed = done
    rows = formatted["DIAGNOSIS"].count()
    keys = formatted["DIAGNOSIS"].select("DIAGNOSISID").distinct().count()
    assert rows > keys
    assert read_stage(spark, job.path("mapped", "DIAGNOSIS")).count() == keys
    assert read_stage(spark, job.path("deduplicated/surplus", "DIAGNOSIS")).count() == rows - keys


def test_codes_ids_and_audit(done):
    _, _, fixed = done
    r = fixed["DEMOGRAPHIC"].where("SEX IS NOT NULL").first()
    assert r["SEX"] == "FE" and len(r["PATID"]) == 64 and (r["UPDATED"], r["SOURCE"]) == ("2024-01-01 00:00:00", "ABC")
    assert fixed["ENCOUNTER"].where("ENC_TYPE = 'ED'").count() > 0


def test_what_fixes_touched_is_written(spark, done):
    job, _, _ = done
    path = job.path("fixed_rejects", "DIAGNOSIS")
    assert read_stage(spark, f"{path}/patient_orphans").count() > 0
    assert "count" in read_stage(spark, f"{path}/encounter_orphans").columns


def test_reports(spark, done):
    job, formatted, _ = done
    tables = {t: formatted[t] for t in ("DEMOGRAPHIC", "ENCOUNTER")}
    months = batch.monthly_report(tables)
    assert months.where("table = 'ENCOUNTER' AND field = 'ADMIT_DATE'").agg(F.sum("count")).first()[0] == tables["ENCOUNTER"].count()
    values = batch.distinct_report(tables)
    assert values.where("field LIKE '%ID'").count() == 0
    assert values.where("table = 'DEMOGRAPHIC' AND field = 'SEX'").agg(F.sum("count")).first()[0] == tables["DEMOGRAPHIC"].count()
    valueset = spark.createDataFrame([("SEX", "M")], "FIELD_NAME STRING, VALUESET_ITEM STRING")
    gap = batch.mapping_gap(tables, job.code_map, valueset)
    assert gap["missing_mapping"].where("table = 'DEMOGRAPHIC'").count() == 0
    assert gap["missing_mapping"].where("table = 'ENCOUNTER'").count() == 4
    assert gap["suggested"].where("entry LIKE '%# %'").count() == 4
    assert gap["all_mapping"].where("target = 'FE'").count() == 1


def test_results_and_addresses_are_placed_last(spark, tmp_path):
    tables = Views(Inputs(spark, SMALL), views.FLAT)
    names = ("LAB_RESULT_CM", "OBS_CLIN", "LDS_ADDRESS_HISTORY")
    formatted = {t: run_job(flat.JOBS[t], tables) for t in names}
    lab = formatted["LAB_RESULT_CM"]
    flags = lab.select(F.col("LAB_LOINC").alias("loinc_num")).distinct().where("loinc_num LIKE '1%'")
    flags = flags.selectExpr("loinc_num", "'0' AS found_in_lab", "'1' AS found_in_obs_clin", "'0' AS found_in_obs_gen")
    site = mapping.Site("ABC", "key", updated="2024-01-01 00:00:00")
    codes = code_map(spark, {("LAB_RESULT_CM", "PRIORITY"): {"R": "RT"}})
    absent = ("DEMOGRAPHIC", "ENCOUNTER", "PROVIDER")
    with pytest.raises(ValueError, match="DEMOGRAPHIC"):
        batch.run_batch(spark, batch.Batch(str(tmp_path / "x"), site, codes), formatted)
    plain = batch.run_batch(spark, batch.Batch(str(tmp_path / "a"), site, codes, absent_parents=absent), formatted)
    history = plain["LDS_ADDRESS_HISTORY"].where("ADDRESS_STATE = 'FL'")
    job = batch.Batch(str(tmp_path / "b"), site, codes, code_locations=flags, address_history=history, absent_parents=absent)
    placed = batch.run_batch(spark, job, formatted)
    moved = plain["LAB_RESULT_CM"].where("LAB_LOINC LIKE '1%'").count()
    assert moved > 0 and placed["LAB_RESULT_CM"].where("LAB_LOINC LIKE '1%'").count() == 0
    assert placed["OBS_CLIN"].count() == plain["OBS_CLIN"].count() + moved
    assert placed["OBS_CLIN"].columns == plain["OBS_CLIN"].columns
    assert placed["LDS_ADDRESS_HISTORY"].count() == plain["LDS_ADDRESS_HISTORY"].count()
    # results that belong in a table the delivery lacks make that table
    alone = {"LAB_RESULT_CM": lab}
    job = batch.Batch(str(tmp_path / "c"), site, codes, code_locations=flags, absent_parents=absent)
    placed = batch.run_batch(spark, job, alone)
    assert placed["OBS_CLIN"].count() == moved and placed["OBS_CLIN"].count() + placed["LAB_RESULT_CM"].count() == plain["LAB_RESULT_CM"].count()
    classes = flags.selectExpr("loinc_num", "'2' AS classtype")
    job = batch.Batch(str(tmp_path / "d"), site, codes, code_classes=classes, absent_parents=absent)
    assert batch.run_batch(spark, job, alone)["OBS_CLIN"].count() == moved


def test_patients_under_other_ids(spark):
    id_map = spark.createDataFrame([("1", "x")], "old STRING, new STRING")
    tables = {"DEATH": spark.createDataFrame([("1",), ("2",)], "PATID STRING"), "PROVIDER": spark.createDataFrame([("7",)], "PROVIDERID STRING")}
    out = batch.remap_patients(tables, id_map, "old", "new")
    assert [r[0] for r in out["DEATH"].collect()] == ["x"] and out["PROVIDER"].count() == 1


def test_dedup_keys_by_table():
    columns = ["A", "B", "C", "D", "E", "F", "G", "H"]
    assert batch.dedup_keys("VITAL", columns) == ["A"]
    assert batch.dedup_keys("FACT_RELATIONSHIP", columns) == columns[:5]
    assert batch.dedup_keys("INTERVENTION_CONTACT", columns) == columns[:7]
    assert batch.deduplicate("TUMOR_DATE", None) is None


def test_a_partners_own_fix(spark):
    chains.register_fix("no_blank", lambda df, at, field: repairs.delete_when_null(df.withColumn(field, F.nullif(F.col(field), F.lit(""))), field))
    df = spark.createDataFrame([("a",), ("",)], "X STRING")
    good, results = chains.run_chain(df, [chains.step("no_blank", field="X")], chains.Context())
    assert good.count() == 1 and list(results) == ["no_blank_X"]


def test_batches_live_in_the_folder_the_cluster_names(spark):
    class Named:
        conf = {"spark.checkpoint.dir": "/named/by/cluster"}

    assert session.batch_folder(Named, "2024q1") == "/named/by/cluster/2024q1"
    assert session.batch_folder(spark, "2024q1").endswith("/2024q1")
