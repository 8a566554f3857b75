"""Byte-range checksums and reject records."""

import hashlib

import pytest

from dqforge.operators import integrity as I
from dqforge.sources import byte_ranges as B
from dqforge.sources.files import clean_rows, load_csv_checked
from dqforge.sources.rejects import rejected_rows

SCHEMA = "id int, note string, day date"


def _etag(data: bytes, part: int) -> str:
    parts = [data[i:i + part] for i in range(0, len(data), part)] or [b""]
    return hashlib.md5(b"".join(hashlib.md5(p).digest() for p in parts)).hexdigest() + f"-{len(parts)}"


def test_etags_of_many_parts_and_no_task_holds_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "READ_BYTES", 100)
    data = {"a.bin": bytes(range(256)) * 40, "b.bin": b"", "c d=1.bin": b"x" * 999, "e.bin": b"y" * 1000, "f.bin": b"z" * 1001}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    got = {r.file_name: r for r in I.file_checksums(spark, str(tmp_path), part_bytes=1000).collect()}
    del data["b.bin"]  # Spark lists no empty files
    assert {n: (r.length, r.md5, r.etag) for n, r in got.items()} == {
        n: (len(c), hashlib.md5(c).hexdigest(), _etag(c, 1000)) for n, c in data.items()}
    plain = {r.file_name: r.md5 for r in I.file_checksums(spark, str(tmp_path)).collect()}
    assert plain == {n: hashlib.md5(c).hexdigest() for n, c in data.items()}
    parts = B.file_ranges(B.list_files(spark, str(tmp_path)), 1000).where("path LIKE '%a.bin'").orderBy("part").collect()
    assert [(r.part, r.start, r["size"]) for r in parts] == [(i, i * 1000, min(1000, 10240 - i * 1000)) for i in range(11)]
    without = {r.path.rsplit("/", 1)[1]: r.md5 for r in B.multipart_checksums(spark, str(tmp_path), 1000, whole=False).collect()}
    assert without["a.bin"] is None and without["e.bin"] == hashlib.md5(data["e.bin"]).hexdigest()


def test_no_task_reads_a_long_file_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "STEP_BYTES", 700)
    monkeypatch.setattr(B, "STEPS_A_JOB", 4)
    data = {"a.bin": bytes(range(256)) * 40, "b.bin": b"x" * 699, "c.bin": b"y" * 700, "d.bin": b"z" * 1401}
    (tmp_path / "files").mkdir()
    for name, content in data.items():
        (tmp_path / "files" / name).write_bytes(content)
    sums = {n: hashlib.md5(c).hexdigest() for n, c in data.items()}
    got = I.file_checksums(spark, str(tmp_path / "files"))
    assert {r.file_name: (r.length, r.md5) for r in got.collect()} == {n: (len(data[n]), m) for n, m in sums.items()}
    log = str(tmp_path / "reads")

    class Counted:
        def __init__(self, path):
            self.f, self.n = B.open_range(path), 0

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.f.close()
            with open(log, "a") as out:
                out.write(f"{self.n}\n")

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            got = self.f.read(n)
            self.n += len(got)
            return got

    found = B.multipart_checksums(spark, str(tmp_path / "files"), 1000, opener=Counted).collect()
    assert {r.path.rsplit("/", 1)[1]: (r.md5, r.etag) for r in found} == {n: (m, _etag(data[n], 1000)) for n, m in sums.items()}
    reads = [int(n) for n in open(log)]
    assert max(reads) <= 700 and sum(reads) == sum(len(c) * (2 if len(c) > 1000 else 1) for c in data.values())


def test_a_file_that_shrinks_is_an_error(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x" * 50)
    files = spark.createDataFrame([(str(tmp_path / "a.bin"), 80)], "path string, length long")
    with pytest.raises(Exception, match="before its listed length"):
        B.range_checksums(B.file_ranges(files, 1000)).collect()
    with pytest.raises(ValueError):
        B.file_ranges(files, 0)


def test_own_opener(spark, tmp_path):
    import io

    files = spark.createDataFrame([("store://x", 5)], "path string, length long")
    got = B.range_checksums(B.file_ranges(files, 3, whole=True), opener=lambda path: io.BytesIO(b"12345")).collect()
    assert {r.part: r.md5 for r in got} == {p: hashlib.md5(b).hexdigest() for p, b in ((0, b"123"), (1, b"45"), (-1, b"12345"))}


def _found(df):
    return sorted(((r.path.rsplit("/", 1)[1], r.line_number, r.column_name, r.reason, r.token, r.raw_line) for r in df.collect()), key=str)


def test_reject_records(spark, write_text):
    path = write_text("r/a.csv", 'id,note,day\n1,x,2024-01-01\n\nz,"a\\"b,c",2024-02-30\n"a\\"b,c",d\n4,x,2024-01-01,more\n5,"open,2024-01-01\n6,x,\n7,x,2024-01-01,,\n   \n8\n')
    got = _found(rejected_rows(spark, path, SCHEMA, header=True, allow_jagged=False, required=["day"]))
    assert [g[:4] for g in got] == [
        ("a.csv", 11, None, "short_row"), ("a.csv", 4, "day", "not_castable"), ("a.csv", 4, "id", "not_castable"), ("a.csv", 5, "id", "not_castable"),
        ("a.csv", 5, None, "short_row"), ("a.csv", 6, None, "too_many_fields"), ("a.csv", 7, None, "unterminated_quote"), ("a.csv", 8, "day", "null_in_required"),
        ("a.csv", 9, None, "too_many_fields")]
    assert got[1][4:] == ("2024-02-30", 'z,"a\\"b,c",2024-02-30') and got[3][4] == 'a"b,c'
    jagged = {g[1:4] for g in _found(rejected_rows(spark, path, SCHEMA, header=True, required=["day"]))}
    assert (11, "day", "null_in_required") in jagged and not any(r == "short_row" for _, _, r in jagged)
    # without the header option line 1 is a record
    assert (1, "id", "not_castable") in {g[1:4] for g in _found(rejected_rows(spark, path, SCHEMA))}
    with pytest.raises(ValueError):
        rejected_rows(spark, path, SCHEMA, multiLine=True)


def test_the_checked_load_agrees_with_the_reject_records(spark, write_text):
    text = '"a\\"b,c",d\n1,x,2024-01-01\n2,"a\\"b,c",2024-01-01\n3,"a,b"\n4,"x,2024-01-01\n5,"a,b",2024-01-01,\n'
    path = write_text("s/a.csv", text)
    checked = load_csv_checked(spark, path, SCHEMA, allow_jagged=False)
    rows = {r._n_fields: (r._short, r._too_many, r._error) for r in checked.collect()}
    assert rows[2] == (True, False, True) and rows[3] == (False, False, False) and rows[4] == (False, True, True) and rows[-1] == (False, False, True)
    bad_lines = {g[1] for g in _found(rejected_rows(spark, path, SCHEMA, allow_jagged=False))}
    assert bad_lines == {1, 4, 5, 6} and clean_rows(checked).count() == 2
    semi = write_text("t/a.csv", "1;'a;b';2024-01-01\n2;'a;b'\n")
    assert [g[1] for g in _found(rejected_rows(spark, semi, SCHEMA, allow_jagged=False, sep=";", quote="'"))] == [2]


def test_lines_are_numbered_over_splits(spark, tmp_path):
    lines = ["bad" if i % 97 == 0 else str(i) for i in range(20_000)]
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("\n".join(f"{x},{'y' * (hash((name, i)) % 30)},2024-01-01" for i, x in enumerate(lines)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = rejected_rows(spark, str(tmp_path), SCHEMA)
        assert {(r.path.rsplit("/", 1)[1], r.line_number) for r in got.collect()} == {(n, i + 1) for n in ("a.csv", "b.csv") for i in range(0, 20_000, 97)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_file_a_task(spark, tmp_path):
    from dqforge.plans.load_queries import _write_files

    rows = [(None if i == 16 else i, i, f"{i}") for i in range(17)]
    _write_files(spark.createDataFrame(rows, "g int, k int, value string"), 16, ["k"], str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("g=*/part-*.txt"))
    tasks = [f.name.split("-")[1] for f in files if "__HIVE" not in str(f)]
    assert len(files) == 17 and len(tasks) == len(set(tasks)) == 16
    assert {f.parent.name: f.read_text() for f in files} == {f"g={'__HIVE_DEFAULT_PARTITION__' if g is None else g}": f"{v}\n" for g, _, v in rows}


def test_rejected_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x,2024-01-01\nq,x,2024-01-01\n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rejected_rows(spark, str(tmp_path), SCHEMA)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert [(r.line_number, r.column_name) for r in found.collect()] == [(2, "id")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
