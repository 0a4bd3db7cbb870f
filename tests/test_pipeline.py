"""The stage list end to end on invented landed files."""

from __future__ import annotations

import zipfile

import pytest

from coverlens import layouts
from coverlens.plans.jobs import Pipeline

HEADER = ";".join(layouts.ENROLMENT_COLUMNS)


def enrolment_line(carrier, state, locality, name, sex, plan, active, joined=0, cancelled=0):
    return ";".join(
        ["2024-12", carrier, "NAME", "11", "KIND", state, locality, name, sex, "20 a 24 anos", "x", plan, "P", "Ind",
         "Amb", "Nac", "Med", "Titular", str(active), str(joined), str(cancelled), "2026-01-01"]
    )


LINES = [
    enrolment_line("000001", "RR", "140010", "Boa Vista", "F", "111", 10, 1, 0),
    enrolment_line("000001", "RR", "140010", "Boa Vista", "F", "222", 5),
    enrolment_line("000001", "RR", "140010", "Boa Vista", "F", "222", 5),
    enrolment_line("999999", "RR", "140002", "Amajari", "m", "333", 3, 1, 1),
    enrolment_line("000002", "ZZ", "1", "Nowhere", "", "444", 7),
]

CARRIER_HEADER = (
    "REGISTRO_OPERADORA;CNPJ;Razao_Social;Nome_Fantasia;Modalidade;Logradouro;Cidade;UF;Telefone;Representante;"
    "Data_Registro_ANS"
)


def land(root, carriers, lines=LINES):
    enrol = root / "raw" / "enrolment" / "202412"
    enrol.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(enrol / "pda-024-icb-RR-2024_12.zip", "w") as z:
        z.writestr("rows.csv", "\n".join([HEADER, *lines]))
    for day, rows in carriers.items():
        folder = root / "raw" / "carriers" / f"snapshot_date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "register.csv").write_text("\n".join([CARRIER_HEADER, *rows]), encoding="utf-8")
    fac = root / "raw" / "facilities" / "202412"
    fac.mkdir(parents=True, exist_ok=True)
    (fac / "a.csv").write_text(
        "CO_CNES;NO_FANTASIA;TP_UNIDADE;DS_TP_UNIDADE;CO_MUNICIPIO;NO_MUNICIPIO;CO_UF\n"
        "1;Hospital;05;Hospital Geral;140010;Boa Vista;RR\n2;Posto;02;Posto;140010;Boa Vista;RR\n",
        encoding="utf-8",
    )
    (fac / "b.txt").write_text("CO_CNES,NO_FANTASIA,CO_MUNICIPIO,CO_UF\n2,Copy,140010,RR\n3,Other,140002,RR\n")


CARRIERS = {
    "2025-12-01": ["000001;11111111000191;OLD;;Coop;Rua;BV;RR;9;F;2020-01-01"],
    "2026-01-01": [
        "000001;11111111000191;ONE;;Coop;Rua;BV;RR;9;FULANO;2020-01-01",
        "000002;22;TWO;NA;Med;Rua;RB;ac;8;C;not a date",
        "000002;22;TWO AGAIN;;Med;Rua;RB;AC;8;C;2019-05-10",
    ],
}


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    land(root, CARRIERS)
    job = Pipeline(spark, str(root), "2024-12", "2026-01-01")
    assert job.run(), job.reports
    return root, job


def test_all_stages_succeed_and_are_logged(done):
    _, job = done
    assert {r.status for r in job.reports} == {"SUCCESS"}
    runs = job.log.runs().collect()
    assert len(runs) == len(job.reports)
    assert all(r["finished_at"] is not None and r["duration_seconds"] >= 0 for r in runs)


def test_transform_counts_duplicates_and_sums_plans(done):
    _, job = done
    report = next(r for r in job.reports if r.stage == "transform" and r.source == "enrolment")
    assert report.counters["rows_read"] == 5
    assert report.counters["exact_duplicates"] == 1
    assert report.counters["rows_written"] == 3
    carriers = next(r for r in job.reports if r.stage == "transform" and r.source == "carriers")
    assert carriers.counters["repeats_removed"] == 1 and carriers.counters["rows_read"] == 3
    facilities = next(r for r in job.reports if r.stage == "transform" and r.source == "facilities")
    assert facilities.counters["repeats_removed"] == 1 and facilities.counters["rows_written"] == 3


def test_fact_keys_and_sums(done):
    _, job = done
    star = job.star()
    rows = star.enrolment.collect()
    assert sum(r["active"] for r in rows) == 25
    codes = {r["carrier_sk"]: r["carrier_code"] for r in star.carrier.collect()}
    assert {codes[r["carrier_sk"]] for r in rows} == {"000001", "000000", "000002"}
    # The row with the unknown state keeps its members on the unknown locality.
    assert {r["locality_sk"] for r in rows if r["active"] == 7} == {-1}
    assert {r["sex"] for r in rows} == {"F", "M", None}


def test_newest_snapshot_wins_and_personal_fields_are_gone(done):
    _, job = done
    carriers = {r["carrier_code"]: r for r in job.star().carrier.collect()}
    assert carriers["000001"]["legal_name"] == "ONE"
    assert carriers["000002"]["legal_name"] == "TWO" and carriers["000002"]["trade_name"] is None
    assert carriers["000002"]["registered_on"] is None and carriers["000002"]["seat_state"] == "AC"
    assert "Representante" not in job.star().carrier.columns


def test_second_load_changes_nothing(done, spark):
    root, job = done
    before = sorted(map(tuple, job.star().enrolment.drop("run_id").collect()), key=str)
    again = Pipeline(spark, str(root), "2024-12", "2026-01-01")
    assert again.run("load")
    load = next(r for r in again.reports if r.source == "enrolment")
    assert load.counters["inserted"] == 0 and load.counters["updated"] == 3
    network = next(r for r in again.reports if r.source == "facilities")
    assert network.counters["inserted"] == 0 and network.counters["updated"] == 3
    assert sorted(map(tuple, again.star().enrolment.drop("run_id").collect()), key=str) == before


def test_summary_and_exports(done, spark):
    root, job = done
    summary = {r["state"]: r for r in job.warehouse.read("state_summary").collect()}
    assert summary["RR"]["active_members"] == 18 and summary["RR"]["facilities"] == 3
    assert float(summary["RR"]["members_per_facility"]) == 6.0
    assert len(list((root / "analytics" / "period=202412").iterdir())) == 8
    assert spark.sql("select count(*) from coverage_class").first()[0] > 0


def test_extract_registers_once(done, spark):
    root, _ = done
    again = Pipeline(spark, str(root), "2024-12", "2026-01-01")
    assert again.run("extract")
    assert {r.counters["new"] for r in again.reports} == {0}
    assert again.run("extract", force=True)
    assert all(r.counters["new"] > 0 for r in again.reports[3:])


def test_broken_archive_stops_before_transform(spark, tmp_path):
    land(tmp_path, CARRIERS)
    (tmp_path / "raw" / "enrolment" / "202412" / "pda-024-icb-AC-2024_12.zip").write_bytes(b"not an archive")
    job = Pipeline(spark, str(tmp_path), "2024-12", "2026-01-01", sources=("enrolment",))
    assert not job.run()
    assert job.reports[-1].stage == "validate_raw" and job.reports[-1].status == "FAILED"
    # The transform itself skips the file and reports a partial success.
    assert job.run("transform")
    assert job.reports[-1].status == "PARTIAL" and job.reports[-1].counters["files_ignored"] == 1


def test_missing_input_fails_the_stage(spark, tmp_path):
    job = Pipeline(spark, str(tmp_path), "2024-12", "2026-01-01", sources=("facilities",))
    assert not job.run("transform")
    assert job.reports[-1].status == "FAILED" and job.reports[-1].error


def test_all_rejected_is_a_failure(spark, tmp_path):
    land(tmp_path, CARRIERS, [enrolment_line("000001", "RR", "", "x", "F", "1", 5)])
    job = Pipeline(spark, str(tmp_path), "2024-12", "2026-01-01", sources=("enrolment",))
    assert not job.run()
    assert job.reports[-1].stage == "validate_trusted" and job.reports[-1].counters["rejected"] == 1
    rejects = spark.read.json(str(tmp_path / "rejected"))
    assert rejects.first()["rule"] == "locality_missing"
