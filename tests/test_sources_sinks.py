"""Files in every layout, stage tables, and loading through the session's catalog."""

import pytest
from pyspark.sql import functions as F

from careloom.functions.ids import pseudonym
from careloom.operators import schema
from careloom.plans import pcornet
from careloom.plans.spec import columns_used
from careloom.session import tune
from careloom.sinks import stage
from careloom.sinks import warehouse as load
from careloom.sources import files, reference, warehouse
from tests.conftest import rows


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.mark.parametrize("sep", [",", "\t", "~", ";", "|"])
def test_delimited_text_stays_text(spark, tmp_path, sep):
    path = write(tmp_path / "a.txt", f'id{sep}note\n001{sep}"a{sep}""b"""\n2{sep}\n')
    df = files.read_delimited(spark, path, sep)
    assert [f.dataType.typeName() for f in df.schema] == ["string", "string"]
    assert rows(df) == sorted([("001", f'a{sep}"b"'), ("2", None)], key=repr)
    assert ("2", "") in rows(files.read_delimited(spark, path, sep, blank_is_null=False))


def test_glob_of_files_is_one_table(spark, tmp_path):
    for n in "12":
        write(tmp_path / f"Death_{n}.txt", f"id,v\n{n},x\n")
    write(tmp_path / "Other.txt", "id,v\n9,x\n")
    assert rows(files.read_delimited(spark, f"{tmp_path}/Death*", ",").select("id")) == [("1",), ("2",)]


def test_bad_lines_are_kept_apart(spark, tmp_path):
    """Short, long and unclosed lines of several files, each once, with their file; good rows as ever."""
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", 'A,B,C\n1,"x,y",3\n1,2\n,,\n1,2,3,4\n')
    write(tmp_path / "in" / "b.csv", 'A,B,C\n"open,2,3\n7,8,9\n')
    checked = files.read_checked(spark, f"{tmp_path}/in/*.csv", ",")
    written = []

    def settle(df):
        written.append(df)
        stage.write_stage(df, f"{tmp_path}/checked", by="__touched")
        return files.read_stage(spark, f"{tmp_path}/checked", df.schema)

    for result in (checked, checked.settle(settle)):
        assert rows(result.good) == sorted([("1", "x,y", "3"), (None, None, None), ("7", "8", "9")], key=repr)
        assert result.good.select("B").where("B = '8'").count() == 1  # one column only
        found = [(r["file"].rsplit("/")[-1], r["record"]) for r in result.rejects.collect()]
        assert sorted(found) == [("a.csv", "1,2"), ("a.csv", "1,2,3,4"), ("b.csv", '"open,2,3')]
        assert sorted((r["file"].rsplit("/")[-1], r["count"]) for r in result.report.collect()) == [("a.csv", 2), ("b.csv", 1)]
    assert len(written) == 1
    empty = files.read_checked(spark, write(tmp_path / "e.csv", "A,B\n"), ",", blank_is_null=False)
    assert empty.good.columns == ["A", "B"] and empty.good.count() == empty.rejects.count() == 0


def test_header_only_file_is_an_empty_table(spark, tmp_path):
    df = files.read_delimited(spark, write(tmp_path / "e.txt", "id\tv\n"))
    assert df.columns == ["id", "v"] and df.count() == 0


def test_the_layout_that_fits_is_chosen(spark, tmp_path):
    layouts = [files.Layout("~", ("id", "v")), files.Layout(";", ("id", "v"), {"extra": "V", "none": None})]
    lower = files.read_variants(spark, write(tmp_path / "l.txt", "id~v\n1~x\n"), layouts)
    upper = files.read_variants(spark, write(tmp_path / "u.txt", "ID;V\n1;x\n"), layouts)
    assert rows(lower) == [("1", "x")] and rows(upper) == [("1", "x", "x", None)]
    with pytest.raises(ValueError):
        files.read_variants(spark, write(tmp_path / "n.txt", "a,b\n1,2\n"), layouts)


def test_shaped_extract_in_both_layouts(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    write(tmp_path / "a" / "x_Clinical_1.txt", "obsclinid~" + "~".join(
        "patid encounterid obsclin_providerid obsclin_start_date obsclin_start_time obsclin_stop_date obsclin_stop_time obsclin_type "
        "obsclin_code obsclin_result_qual obsclin_result_text obsclin_result_snomed obsclin_result_num obsclin_result_modifier "
        "obsclin_result_unit obsclin_source obsclin_abn_ind raw_obsclin_name raw_obsclin_code raw_obsclin_type raw_obsclin_result "
        "raw_obsclin_modifier raw_obsclin_unit".split()) + "\n1~p~e~d~02/03/2020~10:30~~~LC~c~low~~~5.5~EQ~kg~OD~AB~~~~~~\n")  # fmt: skip
    write(tmp_path / "b" / "x_Clinial_1.txt", "OBSCLINID;" + ";".join(
        "PATID ENCOUNTERID OBSCLIN_PROVIDERID OBSCLIN_DATE OBSCLIN_TIME OBSCLIN_TYPE OBSCLIN_CODE OBSCLIN_RESULT_QUAL OBSCLIN_RESULT_TEXT "
        "OBSCLIN_RESULT_SNOMED OBSCLIN_RESULT_NUM OBSCLIN_RESULT_MODIFIER OBSCLIN_RESULT_UNIT OBSCLIN_SOURCE RAW_OBSCLIN_NAME "
        "RAW_OBSCLIN_CODE RAW_OBSCLIN_TYPE RAW_OBSCLIN_RESULT RAW_OBSCLIN_MODIFIER RAW_OBSCLIN_UNIT".split())
        + "\n1;p;e;d;2020-02-03 10:30:00;2020-02-03 10:30:00;LC;c;low;;;5.5;EQ;kg;OD;;;;;;\n")
    for folder, stop, abnormal in (("a", None, "AB"), ("b", "2020-02-03", None)):
        [(df, layout)] = pcornet.read(spark, "OBS_CLIN", str(tmp_path / folder))
        r = pcornet.run("OBS_CLIN", df, layout.sep).first()
        assert (r["OBSCLIN_START_DATE"], r["OBSCLIN_START_TIME"], r["OBSCLIN_STOP_DATE"]) == ("2020-02-03", "10:30", stop)
        assert (r["OBSCLIN_RESULT_QUAL"], r["OBSCLIN_RESULT_NUM"], r["OBSCLIN_ABN_IND"]) == ("OT", 5.5, abnormal)


def test_files_of_all_patterns_and_layouts_are_read(spark, tmp_path):
    columns = sorted({c for c in columns_used(pcornet.JOBS["MED_ADMIN"])} | {"MEDADMINID"})
    write(tmp_path / "x_Medadmin_1.txt", "~".join(columns).lower() + "\n" + "~".join("1" for _ in columns) + "\n")
    write(tmp_path / "x_Med_Admin_2.txt", "~".join(columns).lower() + "\n" + "~".join("2" for _ in columns) + "\n")
    write(tmp_path / "y_Med_Admin_3.txt", ";".join(columns) + "\n" + ";".join("3" for _ in columns) + "\n")
    assert {r["MEDADMINID"] for r in pcornet.read_and_run(spark, "MED_ADMIN", str(tmp_path)).collect()} == {"1", "2", "3"}
    with pytest.raises(FileNotFoundError):
        pcornet.read(spark, "VITAL", str(tmp_path))


def test_disposition_comes_from_another_column_in_the_second_layout(spark):
    columns = sorted({c.upper() for c in columns_used(pcornet.JOBS["ENCOUNTER"])} | {"DISCHARGE_DISPOSITION"})
    df = spark.createDataFrame(
        [tuple("30000000|638666" if c == "DISCHARGE_DISPOSITION" else None for c in columns)], ", ".join(f"{c} STRING" for c in columns)
    )
    assert pcornet.run("ENCOUNTER", df, "~").first()["DISCHARGE_DISPOSITION"] == "A"
    assert pcornet.run("ENCOUNTER", df, ";").first()["DISCHARGE_DISPOSITION"] == "E"


def test_lists_and_specs(spark, tmp_path):
    assert rows(files.read_code_list(spark, write(tmp_path / "c.csv", "a-1\nb-2\n"))) == [("a-1",), ("b-2",)]
    assert rows(files.read_code_list(spark, write(tmp_path / "h.csv", "code\nb-2\n"), header=True)) == [("b-2",)]
    text = "TABLE_NAME,FIELD_NAME,RDBMS_DATA_TYPE\nDEATH,PATID,RDBMS Text(x)\nDEATH,DEATH_DATE,RDBMS Date\nVITAL,HT,RDBMS Number(x)\n"
    spec = reference.read_spec(spark, write(tmp_path / "s.csv", text))
    assert reference.table_headers(spec, "DEATH") == ["PATID", "DEATH_DATE"]
    assert rows(reference.tables_with_field(spec, "DATE")) == [("DEATH",)]
    codes = reference.read_code_map(spark, write(tmp_path / "m.csv", "table,field,source_value,target_value\nT,F,a,\nT,F,b,B\n"))
    assert reference.table_dictionary(codes, "T").count() == 2


def test_stage_and_export(spark, tmp_path):
    df = spark.range(3).select(F.col("id").cast("string").alias("ID"), F.lit(None).alias("NOTHING"))
    stage.write_stage(df, f"{tmp_path}/s")
    stage.write_stage(df, f"{tmp_path}/s")
    assert files.read_stage(spark, f"{tmp_path}/s").count() == 3
    stage.export_text(df, f"{tmp_path}/t", files=1)
    assert rows(files.read_delimited(spark, f"{tmp_path}/t")) == [("0", None), ("1", None), ("2", None)]
    stage.write_union([df.select("ID"), df.withColumn("MORE", F.lit("m"))], f"{tmp_path}/u")
    assert files.read_stage(spark, f"{tmp_path}/u").count() == 6


def test_digests_take_little_more_than_half_their_length_on_disk(spark, tmp_path):
    digests = tune(spark).range(20_000).select(pseudonym(F.col("id"), "ABC", "key").alias("PATID"))
    stage.write_stage(digests, str(tmp_path / "ids"))
    assert sum(f.stat().st_size for f in (tmp_path / "ids").glob("*.parquet")) < 20_000 * 40
    assert spark.read.parquet(str(tmp_path / "ids")).exceptAll(digests).isEmpty()


def test_widths_are_seen_while_a_stage_is_written(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 100), ("bcd", None, 5)], "T STRING, NOTHING STRING, N INT")
    seen = stage.write_measured_stage(df, f"{tmp_path}/m")
    assert seen == stage.stage_widths(spark, f"{tmp_path}/m") == schema.observed_widths(df) == {"T": 3, "NOTHING": 1, "N": 3}
    assert stage.write_measured_stage(df.limit(0), f"{tmp_path}/e") == {"T": 1, "NOTHING": 1, "N": 1}


class TestWarehouse:
    fields = [("PATID", "RDBMS Text(x)"), ("DEATH_DATE", "RDBMS Date"), ("DEATH_SOURCE", "RDBMS Text(2)")]

    def df(self, spark, *data):
        return spark.createDataFrame(list(data), "PATID STRING, DEATH_DATE STRING, DEATH_SOURCE STRING")

    def test_replace_then_merge(self, spark):
        spark.sql("CREATE SCHEMA IF NOT EXISTS cdm")
        target = load.Target(prefix="cdm.", partitions=2)
        load.upload("warehouse", self.df(spark, ("1", "2020-01-01", "L"), ("2", "bad", "L")), target, "q1", "DEATH", self.fields)
        first = warehouse.read_table(spark, "cdm.q1_DEATH")
        assert dict(first.dtypes)["DEATH_DATE"] == "date" and first.where("DEATH_DATE IS NULL").count() == 1
        batch = self.df(spark, ("2", "2020-02-02", "L"), ("3", "2020-03-03", "L"))
        load.merge_table(batch, first, target, "q2", "DEATH", self.fields)
        merged = warehouse.read_table(spark, "cdm.q2_merged_DEATH")
        assert rows(merged.select("PATID", F.col("DEATH_DATE").cast("string"))) == [("1", "2020-01-01"), ("2", "2020-02-02"), ("3", "2020-03-03")]
        assert "q1_death" in {r["tableName"] for r in warehouse.list_tables(spark, "cdm").collect()}

    @pytest.mark.parametrize("merged", [False, True])
    def test_loads_run_their_plan_once(self, spark, tmp_path, merged):
        """Each row of the input is made once, and the widths are those of its rows."""
        spark.sql("CREATE SCHEMA IF NOT EXISTS once")
        count = spark.sparkContext.accumulator(0)

        def tick(batches):
            for batch in batches:
                count.add(batch.num_rows)
                yield batch

        df = self.df(spark, ("1", "2020-01-01", "L"), ("22", "2020-01-02", "Long")).mapInArrow(tick, "PATID STRING, DEATH_DATE STRING, DEATH_SOURCE STRING")
        target = load.Target(prefix="once.")
        if merged:
            load.merge_table(df, self.df(spark, ("333", "2020-01-03", "L")), target, "b", "DEATH", self.fields, str(tmp_path))
        else:
            load.replace_table(df, target, "b", "DEATH", self.fields, str(tmp_path))
        assert count.value == 2
        loaded = warehouse.read_table(spark, "once.b_merged_DEATH" if merged else "once.b_DEATH")
        assert loaded.count() == 2 + merged
        assert loaded.schema["DEATH_SOURCE"].metadata["maxlength"] == 4

    def test_missing_tables_are_created_empty(self, spark):
        spark.sql("CREATE SCHEMA IF NOT EXISTS gaps")
        spark.sql("CREATE TABLE IF NOT EXISTS gaps.vital (HT DOUBLE) USING parquet")
        spec = spark.createDataFrame(
            [("DEATH", "PATID", "RDBMS Text(x)"), ("DEATH", "DEATH_DATE", "RDBMS Date"), ("VITAL", "HT", "RDBMS Number(x)")],
            ", ".join(f"{c} STRING" for c in reference.SPEC_COLUMNS),
        )
        present = warehouse.list_tables(spark, "gaps")
        assert load.create_missing_tables(spark, spec, present, load.Target(prefix="gaps.")) == ["DEATH"]
        assert spark.table("gaps.DEATH").columns == ["PATID", "DEATH_DATE", "UPDATED", "SOURCE"]
        assert load.create_missing_tables(spark, spec, warehouse.list_tables(spark, "gaps"), load.Target(prefix="gaps.")) == []

    def test_text_and_typed_writers_prepare_their_columns(self, spark, monkeypatch):
        """No database here: what would be written, and with which options."""
        sent = []
        monkeypatch.setattr(load, "save", lambda df, target, name, mode="overwrite", **extra: sent.append((df, name, extra)))
        target = load.Target("jdbc", {"url": "jdbc:none"})
        load.upload("jdbc_text", self.df(spark, ("1", "x", "L")).withColumn("N", F.lit(1.5)), target, "b", "DEATH")
        typed = schema.table_schema(self.fields)
        load.upload("jdbc_typed", self.df(spark, ("1", "2020-01-01", "L")), target, "b", "DEATH", typed)
        (text, name, _), (df, _, extra) = sent
        assert name == "b_DEATH" and {t for _, t in text.dtypes} == {"string"}
        assert dict(df.dtypes)["DEATH_DATE"] == "date" and "DEATH_DATE DATE" in extra["createTableColumnTypes"]
