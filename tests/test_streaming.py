"""Table jobs on files as they arrive."""

from careloom.plans import flat, mapping
from careloom.plans.spec import run_job
from careloom.sources.reference import code_map
from careloom.streaming.arrivals import append_arrivals, arriving
from tests.conftest import rows


def test_arriving_files_are_formatted_and_mapped(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    codes = code_map(spark, {("DEATH", "DEATH_SOURCE"): {"l": "LOCAL"}})
    site = mapping.Site("ABC", "key", updated="2024-01-01 00:00:00")

    def job(df):
        return mapping.run("DEATH", run_job(flat.JOBS["DEATH"], {"death": df}), codes, site)

    def deliver(name, person):
        (tmp_path / "in" / name).write_text(f"person_id,death_date,death_date_input,death_date_origin\n{person},2020-01-01,N,L\n")
        columns = ["person_id", "death_date", "death_date_input", "death_date_origin"]
        append_arrivals(arriving(spark, inbox, columns, ","), job, out, state).awaitTermination(60)
        return spark.read.parquet(out)

    assert deliver("a.csv", "1").count() == 1
    second = deliver("b.csv", "2")
    assert second.count() == 2 and rows(second.select("DEATH_SOURCE").distinct()) == [("LOCAL",)]
