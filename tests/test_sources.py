from __future__ import annotations

import hashlib
import io
import os
import time
import zipfile
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from coverlens.plans.audit import RunLog, outcome_status
from coverlens.session import scratch_path
from coverlens.sources import archives, commitlog, datasets, delimited, manifest, storage
from coverlens.sources.commitlog import CommitLog, Part
from coverlens.streaming.landing import each_batch, ingest_new_files, landed_stream
from coverlens.streaming.register import read_register, register_deliveries
from coverlens.streaming.upserts import BatchUpsert


def zipped(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in members.items():
            z.writestr(name, body)
    return out.getvalue()


def test_archives_good_and_bad(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped({"readme.txt": "x", "A.CSV": 'k;v;w\n"1";"a;b";NA\n2;"line\nbreak";7\n'}))
    (tmp_path / "b.zip").write_bytes(b"no archive")
    (tmp_path / "c.zip").write_bytes(zipped({"x.txt": "no table"}))
    (tmp_path / "d.zip").write_bytes(b"")
    (tmp_path / "e.zip").write_bytes(zipped({"e.csv": ""}))
    (tmp_path / "f.zip").write_bytes(zipped({"f.csv": "k;v\n9;z\n"}))
    read = archives.read_archives(spark, str(tmp_path), ["k", "v", "w"])
    rows = archives.readable_rows(read).orderBy("_file", "_position").collect()
    assert [(r["k"], r["v"], r["w"], r["_position"]) for r in rows] == [
        ("1", "a;b", None, 0), ("2", "line\nbreak", "7", 1), ("9", "z", None, 0),
    ]
    assert {r["file"][-5:] for r in archives.failed_files(read).collect()} == {"b.zip", "c.zip", "d.zip", "e.zip"}
    problems = {r["path"][-5:]: r["problem"] for r in archives.check_landed_archives(spark, str(tmp_path)).collect()}
    assert problems["a.zip"] is None and problems["d.zip"] == "empty file" and problems["b.zip"]


def _patched(body: bytes, local: int, central: int, value: int) -> bytes:
    """An archive of one member with a two-byte field set in its local and its central header."""
    out = bytearray(body)
    for at in (local, body.index(b"PK\x01\x02") + central):
        out[at : at + 2] = value.to_bytes(2, "little")
    return bytes(out)


def test_damaged_encrypted_and_unknown_archives_are_error_rows(spark, tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", "k;v\n" + "".join(f"{i};{i * i}\n" for i in range(5000)))
    sound = out.getvalue()
    broken = bytearray(sound)
    broken[2000:2064] = b"\xff" * 64
    bodies = {
        "sound": sound, "overwritten": bytes(broken), "encrypted": _patched(sound, 6, 8, 1), "unknown": _patched(sound, 8, 10, 97),
        "cut": sound[: len(sound) // 2], "other": b"no archive",
    }
    for name, body in bodies.items():
        (tmp_path / f"{name}.zip").write_bytes(body)
    read = archives.read_archives(spark, str(tmp_path), ["v", "k"])
    assert archives.readable_rows(read).count() == 5000 and read.count() == 5000 + 5
    assert {r["file"].rsplit("/", 1)[1] for r in archives.failed_files(read).collect()} == {f"{n}.zip" for n in bodies if n != "sound"}
    problems = {r["path"].rsplit("/", 1)[1][:-4]: r["problem"] for r in archives.check_landed_archives(spark, str(tmp_path)).collect()}
    assert {n for n, p in problems.items() if p} == set(bodies) - {"sound"}
    files = spark.createDataFrame([(n, len(b), bytearray(b)) for n, b in bodies.items()], "path string, length long, content binary")
    assert {r["path"] for r in archives.check_archives(files).where("problem is not null").collect()} == set(bodies) - {"sound"}
    unpacked = archives.unpack_archives(files, ["k", "v"])
    assert archives.readable_rows(unpacked).count() == 5000 and archives.failed_files(unpacked).count() == 5


def test_archive_source_plans_by_size_and_prunes(spark, tmp_path):
    rows = spark.range(700).select("id", F.concat(F.lit("f"), F.col("id") % 7, F.lit(".zip")).alias("_file"), (F.col("id") * 2).alias("twice"))
    archives.write_archives(rows, str(tmp_path), order=["id"])
    assert sorted(p.name for p in tmp_path.iterdir()) == [f"f{i}.zip" for i in range(7)]
    read = archives.read_archives(spark, str(tmp_path), ["twice", "none"])
    assert read.columns == ["twice", "none", "_file", "_position", "_failure"]
    one = read.where(F.col("_file") == f"file:{tmp_path}/f3.zip").orderBy("_position").collect()
    assert [int(r["twice"]) for r in one] == [2 * i for i in range(3, 700, 7)] and [r["_position"] for r in one] == list(range(100))
    reader = archives.ArchiveReader({"path": str(tmp_path), "task_bytes": str(3 << 16)}, ["twice", "_file"])
    assert [len(p.files) for p in reader.partitions()] == [2, 2, 2, 1] and reader.columns == ["twice"]
    left = list(reader.pushFilters([archives.EqualTo(("_file",), f"file:{tmp_path}/f3.zip"), archives.EqualTo(("twice",), "6")]))
    assert len(left) == 1 and [len(p.files) for p in reader.partitions()] == [1]
    archives.write_archives(rows.drop("_file").coalesce(1), str(tmp_path / "more"))
    assert archives.read_archives(spark, str(tmp_path / "more"), ["id"]).count() == 700
    with pytest.raises(Exception, match="nothing at"):
        archives.read_archives(spark, str(tmp_path / "absent"), ["id"]).count()


def test_sniffing_respects_quotes(tmp_path, spark):
    assert delimited.sniff(b"a;b\n1;2\n", True) == (";", ["a", "b"])
    assert delimited.sniff(b'"x;y;z",b\n"1;2;3",2\n"4;5;6",3\n', True) == (",", ["x;y;z", "b"])
    assert delimited.sniff(b'a|b\n"line\nbreak, and, more, of, it"|2\n1|2\n', True) == ("|", ["a", "b"])
    assert delimited.sniff(b"a,b;c,d\n1,5;2,5\n1,5;2\n1;7\n", True)[0] == ";"
    assert delimited.sniff("\ufeffk\tv\n1\t2\n".encode(), True) == ("\t", ["k", "v"])
    assert delimited.sniff(b"alone\n1\n", True) == (";", ["alone"]) and delimited.sniff(b" \n", True) is None
    # The sampled bytes end inside a row: that row does not count.
    assert delimited.sniff(b"a,b;c\n1;2\n3;4\n5,6,", False) == (";", ["a,b", "c"])
    (tmp_path / "big.csv").write_text("k;v\n" + "1;2\n" * 100_000)
    found = delimited.detect_separators(spark, str(tmp_path), block=1 << 10)
    assert [tuple(r)[1:] for r in found.collect()] == [(["k", "v"], ";")]
    assert "FileScan text" not in found._jdf.queryExecution().toString()


def test_hash_of_a_file_beyond_the_batch_limit(spark, tmp_path):
    """2.2 GB, mostly a hole: more than one Arrow value or Java array holds."""
    big = tmp_path / "big.csv"
    with big.open("wb") as out:
        out.truncate(2_200_000_000)
        out.seek(0, 2)
        out.write(b"end")
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.CSV").write_bytes(b"abc")
    with big.open("rb") as opened:
        wanted = {"big.csv": hashlib.file_digest(opened, "sha256").hexdigest(), "empty.txt": hashlib.sha256().hexdigest(), "a.CSV": hashlib.sha256(b"abc").hexdigest()}
    listed = manifest.list_landed(spark, str(tmp_path)).collect()
    assert {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in listed} == wanted
    assert {r["length"] for r in listed} == {2_200_000_003, 0, 3}


def test_files_are_listed_in_tasks(spark, tmp_path):
    for name in ("x/a.csv", "x/y/b.csv", "c.txt", "_hidden.csv", "x/z.csv.partial"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    names = lambda *a: {r["path"].removeprefix(f"file:{tmp_path}/") for r in storage.list_files(spark, *a).collect()}
    assert names(str(tmp_path)) == {"x/a.csv", "x/y/b.csv", "c.txt"}
    assert names(str(tmp_path), "*.csv") == {"x/a.csv", "x/y/b.csv"} and names(f"{tmp_path}/x*") == {"x/a.csv", "x/y/b.csv"}
    with pytest.raises(FileNotFoundError):
        storage.list_files(spark, str(tmp_path / "absent"))


def test_a_ragged_file_counts_as_unread(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped({"a.csv": "k;v\n1;2\n3;4;5\n"}))
    read = archives.read_archives(spark, str(tmp_path), ["k", "v"])
    assert archives.readable_rows(read).count() == 0 and archives.failed_files(read).count() == 1


def test_separator_detection(spark):
    lines = spark.createDataFrame([("a;b;c",), ("a,b",), ("a\tb",), ("a|b|c",), ("alone",)], "h string")
    found = [r[0] for r in lines.select(delimited.count_separators("h")).collect()]
    assert found == [";", ",", "\t", "|", ";"]


def test_mixed_layouts_and_line_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k;v\n3;x\n1;y\n2;NULL\n")
    (tmp_path / "b.TXT").write_text("v,k\nq,7\n")
    (tmp_path / "c.dbc").write_text("not read")
    (tmp_path / "d.csv").write_text("")
    rows = delimited.read_detected(spark, str(tmp_path)).orderBy(*delimited.ORIGIN).collect()
    assert [(r["k"], r["v"]) for r in rows] == [("3", "x"), ("1", "y"), ("2", None), ("7", "q")]


def test_latest_snapshot_by_partition(spark, tmp_path):
    for day, value in (("2025-01-01", "old"), ("2025-02-01", "new")):
        folder = tmp_path / f"snapshot_date={day}"
        folder.mkdir()
        (folder / "r.csv").write_text(f"c\n{value}\n")
    rows = delimited.latest_snapshot(delimited.read_delimited(spark, str(tmp_path)))
    assert [r["c"] for r in rows.collect()] == ["new"]


def test_manifest_registers_accepted_suffixes_once(spark, tmp_path):
    for name in ("a.csv", "B.TXT", "c.Zip", "d.pdf"):
        (tmp_path / name).write_text(name)
    listed = manifest.file_manifest(manifest.list_landed(spark, str(tmp_path)), F.lit("s"), F.lit("2024-12"))
    rows = {r["path"].rsplit("/", 1)[1]: r for r in listed.collect()}
    assert set(rows) == {"a.csv", "B.TXT", "c.Zip"}
    assert rows["a.csv"]["size_bytes"] == 5 and len(rows["a.csv"]["sha256"]) == 64
    known = listed.where("path like '%a.csv'")
    assert manifest.not_registered(listed, known).count() == 2
    assert manifest.not_registered(listed, known, force=True).count() == 3


def test_period_write_keeps_other_periods(spark, tmp_path):
    path = str(tmp_path / "d")
    datasets.write_period(spark.createDataFrame([(1, 202401), (2, 202402)], "v int, period_key int"), path)
    datasets.write_period(spark.createDataFrame([(9, 202402)], "v int, period_key int"), path)
    assert {tuple(r) for r in datasets.read_dataset(spark, path).collect()} == {(1, 202401), (9, 202402)}
    assert datasets.read_period(spark, path, 202402).count() == 1
    with pytest.raises(datasets.DatasetMissing):
        datasets.read_period(spark, path, 202403)
    with pytest.raises(datasets.DatasetMissing):
        datasets.read_dataset(spark, str(tmp_path / "none"))


def test_unpublished_load_stays_invisible(spark, tmp_path):
    table = datasets.PublishedTable(spark, str(tmp_path / "t"), "p")
    table.write(spark.createDataFrame([(1, 1), (2, 2)], "v int, p int"), [1, 2])
    # A load that died after writing its files, before publishing.
    spark.createDataFrame([(99, 1)], "v int, p int").write.partitionBy("p").parquet(str(tmp_path / "t/data/version=2"))
    assert {tuple(r) for r in table.read().select("v", "p").collect()} == {(1, 1), (2, 2)}
    table.write(spark.createDataFrame([(5, 1)], "v int, p int"), [1])
    assert {tuple(r) for r in table.read().select("v", "p").collect()} == {(5, 1), (2, 2)}
    table.write(spark.createDataFrame([], "v int, p int"), [2])
    assert {tuple(r) for r in table.read().select("v", "p").collect()} == {(5, 1)}


def test_capped_query_tells_when_rows_are_cut(spark):
    spark.range(10).createOrReplaceTempView("ten")
    rows, cut = datasets.query_mart(spark, "SELECT * FROM ten WHERE id >= :low", {"low": 4}, cap=5)
    assert rows.count() == 5 and cut
    rows, cut = datasets.query_mart(spark, "SELECT * FROM ten WHERE id >= :low", {"low": 5}, cap=5)
    assert rows.count() == 5 and not cut


def test_run_log_folds_events(spark, tmp_path):
    log = RunLog(spark, str(tmp_path))
    a, b = log.start("load", "2024-12", "x"), log.start("load", "2024-12", "y")
    log.finish(a, "SUCCESS", received=5, valid=5)
    rows = {r["run_id"]: r for r in log.runs().collect()}
    assert rows[a]["status"] == "SUCCESS" and rows[a]["received"] == 5 and rows[a]["source"] == "x"
    assert rows[b]["status"] == "RUNNING" and rows[b]["finished_at"] is None
    assert log.rules() is None
    with pytest.raises(ValueError):
        log.finish(b, "DONE")


@pytest.mark.parametrize(("good", "bad", "status"), [(3, 1, "PARTIAL"), (3, 0, "SUCCESS"), (0, 2, "FAILED"), (0, 0, "SUCCESS")])
def test_outcome_status(good, bad, status):
    assert outcome_status(good, bad) == status


def test_each_file_is_ingested_once(spark, tmp_path):
    landing, sink, checkpoint = (str(tmp_path / n) for n in ("landing", "sink", "checkpoint"))
    for round_rows in (3, 0, 2):
        if round_rows:
            spark.range(round_rows).write.mode("append").parquet(landing)
        ingest_new_files(landed_stream(spark, landing, "id long", files_per_batch=1), sink, checkpoint)
    assert spark.read.parquet(sink).count() == 5


def test_stream_upsert_applies_corrections_and_ignores_repeats(spark, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    schema = "period_key int, k string, v long"
    target = BatchUpsert(spark, scratch_path(spark, "stream"), ["period_key", "k"], ["v"], blank_is_null=["k"], stream="s")
    for batch in ([(1, "a", 5), (2, None, 7)], [(1, "a", 6), (2, "", 8), (3, "n", 1)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landing)
        each_batch(landed_stream(spark, landing, schema), target, checkpoint)
    wanted = {(1, "a", 6), (2, None, 8), (3, "n", 1)}
    assert {tuple(r) for r in target.result().select("period_key", "k", "v").collect()} == wanted
    # The same batch number again, as after a failure between merge and commit.
    target(spark.createDataFrame([(1, "a", 100)], schema), 1)
    assert {tuple(r) for r in target.result().select("period_key", "k", "v").collect()} == wanted


def test_racing_appends_each_get_a_number(tmp_path):
    log = CommitLog(str(tmp_path / "log"))

    def writer(who: int) -> list[int]:
        mine = CommitLog(str(tmp_path / "log"))
        return [mine.append(lambda state: [Part(f"t{who}", "all", state.number + 1, True, f"{who}-{i}")], f"writer={who} load={i}") for i in range(15)]

    with ThreadPoolExecutor(6) as pool:
        numbers = [n for mine in pool.map(writer, range(6)) for n in mine]
    assert sorted(numbers) == list(range(1, 91))
    state = log.state()
    assert state.number == 90 and {k: line.folder for k, line in state.parts.items()} == {(f"t{w}", "all"): f"{w}-14" for w in range(6)}
    assert log.has_note("writer=3 load=14") and log.has_note("writer=3 load=2") and not log.has_note("writer=3 load=15")
    assert not log.has_note("writer=9 load=0") and not log.has_note("other")


def test_reading_the_log_costs_the_same_after_many_loads(tmp_path, monkeypatch):
    log = CommitLog(str(tmp_path / "log"))
    assert log.state().number == 0 and log.tidy(0) == 0
    opened = []
    plain = CommitLog._lines
    monkeypatch.setattr(CommitLog, "_lines", lambda self, name: opened.append(name) or plain(self, name))
    for i in range(57):
        log.append(lambda state, i=i: [Part("t", str(i % 3), i, True, str(i))], "free text")
    opened.clear()
    before = log.state()
    assert len(opened) <= commitlog.EVERY and before.number == 57 and len(before.parts) == 3
    assert log.tidy(3600) == 0 and log.tidy(0) == 50 + 4
    assert log.state() == before and log.has_note("free text")
    assert log.append(lambda state: [Part("t", "0", 99, False, "99")]) == 58


def test_two_loads_of_one_part_and_two_of_different_parts(spark, tmp_path):
    table = datasets.PublishedTable(spark, str(tmp_path / "t"), "p")
    frame = lambda p, v: spark.createDataFrame([(v, p)], "v int, p int")
    table.write(frame(1, 0), [1])
    rivals = [table.prepare(frame(1, 10), [1]), table.prepare(frame(1, 20), [1]), table.prepare(frame(2, 30), [2])]
    gate = Barrier(3)

    def race(load):
        gate.wait()
        try:
            datasets.publish([load])
        except datasets.ConcurrentLoad:
            return False
        return True

    with ThreadPoolExecutor(3) as pool:
        won = list(pool.map(race, rivals))
    assert sum(won[:2]) == 1 and won[2]
    assert {(r["p"], r["v"]) for r in table.read().collect()} == {(1, 10 if won[0] else 20), (2, 30)}
    # What nobody can read goes, but only when it is old.
    assert table.vacuum() == 0 and len(list((tmp_path / "t" / "data").iterdir())) == 4
    assert table.vacuum(0) == 2 and table.read().count() == 2


def test_register_knows_deliveries_by_content(spark, tmp_path):
    landed, register = tmp_path / "landed", str(tmp_path / "register")

    def land(name, text):
        (landed / name).parent.mkdir(parents=True, exist_ok=True)
        (landed / name).write_text(text)

    def run(checkpoint, stream):
        register_deliveries(spark, str(landed), register, str(tmp_path / checkpoint), stream)
        return sorted((r["path"], r["length"], r["status"], r["first_path"]) for r in read_register(spark, register).collect())

    assert read_register(spark, register).count() == 0
    land("x/a", "one")
    land("x/b", "")
    assert run("c1", "s1") == [("x/a", 3, "new", "x/a"), ("x/b", 0, "new", "x/b")]
    assert len(run("c1", "s1")) == 2
    time.sleep(0.02)
    land("x/a", "other")  # a changed file of the same name
    land("y/c", "one")  # a known file under another name
    land("y/d.partial", "not yet")
    found = run("c1", "s1")
    assert len(found) == 4 and ("x/a", 5, "new", "x/a") in found and ("y/c", 3, "repeated", "x/a") in found
    assert run("c2", "s2") == found  # a new checkpoint adds nothing that is known
    land("z", "one")
    assert run("c2", "s2") == sorted([*found, ("z", 3, "repeated", "x/a")])


def test_failed_load_publishes_nothing(spark, tmp_path, monkeypatch):
    from coverlens.operators import facts
    from coverlens.plans.loading import Warehouse

    house = Warehouse(spark, str(tmp_path / "house"))
    batch = spark.createDataFrame(
        [("A1", "100", "SP", "Town", "F", "20", "T", "S", 3, 1, 0, 202401)],
        "carrier_code string, locality_code string, state string, locality_name string, sex string, age_band string, "
        "tie_type string, segment string, active long, joined long, cancelled long, "
        "period_key int",
    )

    def broken(*_args, **_kwargs):
        raise RuntimeError("fact step")

    with monkeypatch.context() as patched:
        patched.setattr(facts, "upsert_fact", broken)
        with pytest.raises(RuntimeError, match="fact step"):
            house.load_enrolment(batch, 202401, 1)
    assert not any(table.exists() for table in house.tables.values())
    assert house.load_enrolment(batch, 202401, 2).inserted == 1
    assert {name for name, table in house.tables.items() if table.exists()} == {"time", "locality", "enrolment"}
    log = CommitLog(str(tmp_path / "house" / "published")).state()
    assert len(log.parts) == 3


def test_register_takes_hot_content_and_repeated_batches(spark, tmp_path):
    """Copies are told apart by aggregation, without a state, and a batch that is run again finds what it found before."""
    from coverlens.streaming.register import by_content

    columns = "path string, length long, modified long, sha256 string"
    files = spark.createDataFrame([(f"p{i:04}", 0, 1000 - i, "same") for i in range(300)] + [("q", 1, 5, "known"), ("r", 1, 7, "known")], columns)
    known = spark.createDataFrame([("known", "q", 1, 5, "new", "q")], "sha256 string, path string, length long, modified long, status string, first_path string")
    found = by_content(files, known)
    assert "Window" not in found._jdf.queryExecution().toString()
    shown = {(r["path"], r["status"], r["first_path"]) for r in found.collect()}
    assert shown == {("p0299", "new", "p0299"), ("r", "repeated", "q")} | {(f"p{i:04}", "repeated", "p0299") for i in range(299)}
    landed, register = tmp_path / "landed", str(tmp_path / "register")
    landed.mkdir()
    for name in ("a", "b"):
        (landed / name).write_text("one")
    register_deliveries(spark, str(landed), register, str(tmp_path / "c"), "s")
    before = sorted(map(tuple, read_register(spark, register).collect()))
    commits = sorted((tmp_path / "c" / "commits").glob("[0-9]*"))
    state = tmp_path / "c" / "state"
    assert [r[4] for r in before] == ["new", "repeated"] and not state.exists()
    commits[-1].unlink()  # as if the run had died before its commit
    for crc in (tmp_path / "c" / "commits").glob(".*"):
        crc.unlink()
    register_deliveries(spark, str(landed), register, str(tmp_path / "c"), "s")
    assert sorted(map(tuple, read_register(spark, register).collect())) == before


def test_reject_lines_are_compressed(spark, tmp_path):
    rejected = spark.range(5000).select(F.lit("rule").alias("rule"), F.lit("why it was rejected").alias("reason"), F.struct("id", F.lit(None).cast("string").alias("none")).alias("record"))
    records = datasets.reject_records(rejected, 7, "enrolment", 199801)
    datasets.write_reject_lines(records, str(tmp_path / "r"))
    files = [p for p in (tmp_path / "r").rglob("part-*")]
    assert files and sum(p.stat().st_size for p in files) < 5000 * 40
    back = spark.read.schema(records.schema).json(str(tmp_path / "r"))
    assert back.count() == 5000 and back.agg(F.sum("record.id")).first()[0] == 5000 * 4999 // 2
    assert {(r["run_id"], r["dataset"], r["period_key"]) for r in back.select("run_id", "dataset", "period_key").distinct().collect()} == {(7, "enrolment", 199801)}


def test_damaged_copies_are_written_by_blocks(spark, tmp_path):
    from proofs.sources import write_spoilt

    whole = os.urandom(2_500_001)
    (tmp_path / "docs-0.zip").write_bytes(whole)
    write_spoilt(spark, f"file:{tmp_path}/docs-0.zip", f"file:{tmp_path}")
    assert (tmp_path / "cut.zip").read_bytes() == whole[:1_250_000] and (tmp_path / "empty.zip").read_bytes() == b""
    assert (tmp_path / "overwritten.zip").read_bytes() == whole[:44] + b"\xff" * 16 + whole[60:]


def test_small_archives_are_spread_over_tasks(tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.zip").write_bytes(bytes(3 << 20))
    assert [len(p.files) for p in archives.ArchiveReader({"path": str(tmp_path)}, ["v"]).partitions()] == [1] * 6


def test_staged_rows_are_read_by_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(0, 400_000, 1, 1).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("text"))
    assert datasets.stage_batch(df, str(tmp_path / "s"), 1 << 20).count() == 400_000
    (file,) = (tmp_path / "s").glob("part-*")
    assert pq.ParquetFile(file).num_row_groups > 4
