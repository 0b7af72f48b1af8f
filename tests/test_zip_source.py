"""The zip source: what is opened and parsed, and what comes of short, long and broken rows."""

import csv
import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, Not, StringStartsWith
from pyspark.sql.types import StructType

from tapelens.sources import zip_csv

pytestmark = pytest.mark.usefixtures("spark")
FORM = "trade_date date, source_file string, raw_group string, row_num_in_file bigint, header array<string>, error string, a string, c string"


def write(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)


def reader(folder, form=FORM, **options):
    return zip_csv.PushedReader({"path": str(folder), "slices_per_archive": "2", **options}, StructType.fromDDL(form))


def rows_of(source):
    return [row for part in source.partitions() for batch in source.read(part) for row in batch.to_pylist()]


@pytest.fixture
def counted(monkeypatch):
    """Archives opened, members decompressed."""
    seen = {"archives": 0, "members": []}
    init, member = zipfile.ZipFile.__init__, zipfile.ZipFile.open

    def opened(self, *args, **kwargs):
        seen["archives"] += 1
        init(self, *args, **kwargs)

    def decompressed(self, name, *args, **kwargs):
        seen["members"].append(name.filename)
        return member(self, name, *args, **kwargs)

    monkeypatch.setattr(zipfile.ZipFile, "__init__", opened)
    monkeypatch.setattr(zipfile.ZipFile, "open", decompressed)
    return seen


def test_filters_prune_archives_and_members(tmp_path, counted):
    for day in ("20260102", "20260103", "20260105"):
        write(tmp_path / f"{day}.zip", {"order/1.csv": "a,b,c\n1,2,3\n", "order/2.csv": "a\n1\n", "trade/1.csv": "a\n9\n", "other/1.csv": "a\n"})
    day = zip_csv.archive_date("20260103.zip")
    counted.update(archives=0, members=[])
    source = reader(tmp_path)
    left = [GreaterThan(("a",), "1"), Not(GreaterThan(("trade_date",), day))]
    pushed = [GreaterThan(("trade_date",), zip_csv.archive_date("20260102.zip")), In(("trade_date",), (day, None)), Not(EqualTo(("raw_group",), "other")), StringStartsWith(("source_file",), "order/"), IsNotNull(("raw_group",))]
    assert list(source.pushFilters([*pushed, *left])) == [pushed[1], *left]  # a list with a null is Spark's to decide
    assert len(source.partitions()) == 4 and counted["archives"] == 0
    list(source.pushFilters([EqualTo(("trade_date",), day)]))
    got = rows_of(source)
    assert {(r["source_file"], r["a"], r["c"]) for r in got} == {("order/1.csv", "1", "3"), ("order/2.csv", "1", None)}
    assert counted["archives"] == 2 and sorted(counted["members"]) == ["order/1.csv", "order/2.csv"]  # two slices; each member once


def test_filters_reach_the_source(spark, tmp_path):
    """A pruned archive is not opened: it is no archive."""
    write(tmp_path / "20260102.zip", {"order/1.csv": "a,b,c\n1,2,3\n", "trade/1.csv": "a\n9\n"})
    (tmp_path / "20260103.zip").write_bytes(b"no archive")
    kept = zip_csv.scan(spark, str(tmp_path), FORM, [zip_csv.archive_date("20260102.zip")], ["order"])
    for _ in range(2):
        assert kept.where("raw_group = 'trade'").count() == 0
        assert [(r.source_file, r.a, r.c, r.header) for r in kept.where("a = '1'").collect()] == [("order/1.csv", "1", "3", ["a", "b", "c"])] and kept.count() == 1
    with pytest.raises(Exception, match="not a zip file"):
        zip_csv.scan(spark, str(tmp_path), FORM).count()
    with pytest.raises(Exception, match="cells are text"):
        spark.read.format("zipcsv").schema("a int").load(str(tmp_path)).count()


def test_filters_of_one_query_stay_in_it(spark, tmp_path):
    write(tmp_path / "20260102.zip", {"order/1.csv": "a\n1\n", "trade/1.csv": "a\n9\n"})
    zip_csv.register(spark)
    rows = spark.read.format("zipcsv").schema(FORM).load(str(tmp_path))
    assert (rows.where("raw_group = 'order'").count(), rows.count(), rows.where("raw_group = 'trade'").count(), rows.count()) == (1, 2, 1, 2)


def plain(text):
    """Rows by number, as Python's own reader has them."""
    found = list(csv.DictReader(io.StringIO(text)))
    return [(i, r.get("a"), r.get("c")) for i, r in enumerate(found, 1)]


@pytest.mark.parametrize("block", [64, 4 << 20])
def test_round_trip(tmp_path, monkeypatch, block):
    monkeypatch.setattr(zip_csv, "BLOCK_BYTES", block)
    monkeypatch.setattr(zip_csv, "BATCH_ROWS", 3)
    texts = {
        "g/short.csv": "a,b,c\n1,2,3\n4\n5,6\n7,8,9\n\n10,11,12\n13\n",
        "g/only_short.csv": "a,b,c\n1\n2,3\n",
        "g/quoted.csv": 'a,b,c\n"x,y","line\nbreak","say ""hi"""\n,,\n"short\nrow"\n',
        "g/crlf.csv": "a,b,c\r\n1,2,3\r\n4,5,6\r\n",
        "g/no_end.csv": "c,a\n1,2",
        "g/lacks_c.csv": "a,b\n1,2\n3,4\n",
        "g/none_wanted.csv": "x,y\n1,2\n3,4\n",
        "g/long_run.csv": "a,b,c\n" + "".join(f"{i},{i},{i}\n" if i % 7 else f"{i}\n" for i in range(200)),
    }
    write(tmp_path / "20260102.zip", texts | {"g/empty.csv": "", "g/head.csv": "a,b\n", "g/bom.csv": b"\xef\xbb\xbfa,c\n1,2\n"})
    got = {}
    for r in rows_of(reader(tmp_path)):
        assert r["error"] is None
        got.setdefault(r["source_file"], []).append((r["row_num_in_file"], r["a"], r["c"]))
    assert got == {name: plain(text) for name, text in texts.items()} | {"g/bom.csv": [(1, "1", "2")]}


def test_nothing_of_a_broken_member(tmp_path):
    long = "a,b,c\n" + "1,2,3\n" * 500
    write(tmp_path / "20260102.zip", {"g/long.csv": long + "1,2,3,4\n", "g/bytes.csv": long.encode() + b"1,\xff,3\n", "g/cut.csv": long, "g/good.csv": long})
    data = bytearray((tmp_path / "20260102.zip").read_bytes())
    with zipfile.ZipFile(tmp_path / "20260102.zip") as z:
        at = z.getinfo("g/cut.csv")
        data[at.header_offset + 30 + len(at.filename) + at.compress_size // 2] ^= 0xFF
    (tmp_path / "20260102.zip").write_bytes(data)
    rows = rows_of(reader(tmp_path))
    errors = {r["source_file"]: r["error"] for r in rows if r["error"]}
    assert set(errors) == {"g/long.csv", "g/bytes.csv", "g/cut.csv"} and len(rows) == 503
    assert errors["g/long.csv"] == "ValueError: row 501 has more cells than the header" and "UnicodeDecodeError" in errors["g/bytes.csv"]


def test_one_parse_and_bounded(tmp_path, monkeypatch, counted):
    """A member within the bound is parsed once; one beyond it is parsed again, and comes whole."""
    write(tmp_path / "20260102.zip", {"g/1.csv": "a,b,c\n" + "".join(f"{i},x,{i * 7919 % 10007}\n" for i in range(20_000))})
    counted.update(members=[])
    assert len(rows_of(reader(tmp_path))) == 20_000 and counted["members"] == ["g/1.csv"]
    monkeypatch.setattr(zip_csv, "HELD_BYTES", 10_000)
    counted.update(members=[])
    again = rows_of(reader(tmp_path))
    assert [r["row_num_in_file"] for r in again] == list(range(1, 20_001)) and counted["members"] == ["g/1.csv"] * 2


def test_discovery_log(tmp_path):
    write(tmp_path / "20260102.zip", {"g/1.csv": "a\n1\n"})
    make = lambda: zip_csv.ZipCsvStream({"path": str(tmp_path), "slices_per_archive": "1", "log": str(tmp_path / "log")}, StructType.fromDDL(FORM))
    stream = make()
    start, first = stream.initialOffset(), stream.latestOffset()
    assert first == {"entries": 1} == make().latestOffset()  # nothing new
    write(tmp_path / "20260103.zip", {"g/1.csv": "a\n1\n"})
    write(tmp_path / "20260102.zip", {"g/1.csv": "a\n1\n2\n"})  # replaced: found anew
    second = make().latestOffset()
    names = lambda a, b: [p.path.rsplit("/", 1)[1] for p in make().partitions(a, b)]
    assert names(start, first) == ["20260102.zip"] and names(first, second) == ["20260102.zip", "20260103.zip"]
