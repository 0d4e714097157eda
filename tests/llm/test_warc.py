import hashlib
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from cashtide.llm import warc
from cashtide.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, payload string"


@pytest.fixture
def stored(spark):
    def store(rows, **options):
        path = scratch_path(spark, "warc")
        packages = warc.write_packages(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA), path, **options)
        return packages, warc.read_packages(packages, path)

    return store


LONG = "é" * 600  # 1,200 bytes


def test_round_trip_and_revisits(stored):
    rows = [(1, "http://a", LONG), (5, "http://b c\r\nX: y", LONG), (3, None, LONG), (7, "u", "short"), (8, "u", "short"), (9, "u", None),
            (2, "u", "x" * 999), (4, "u", "x" * 999), (10, "u", "\r\n\r\nbody WARC/1.1"), (None, "u", LONG)]
    _, back = stored(rows)
    got = {r["page_id"]: r for r in back.collect()}
    assert got.keys() == {r[0] for r in rows}
    for page_id, _, html in rows:
        r, data = got[page_id], (html or "").encode()
        revisit = html == LONG and page_id != 5
        assert (r["record_type"], r["refers_to"]) == (("revisit", 5) if revisit else ("response", None))
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == hashlib.sha1(data).hexdigest()
        assert bytes(r["payload"]) == (b"" if revisit else data)
    assert got[5]["url"] == "http://b%20c%0D%0AX:%20y" and got[3]["url"] is None


def test_repeated_rows(stored):
    _, back = stored([(1, "u", LONG), (2, "u", LONG), (2, "u", LONG)])
    assert sorted((r["page_id"], r["record_type"]) for r in back.collect()) == [(1, "revisit"), (2, "response"), (2, "response")]


def test_many_packages(stored):
    packages, back = stored([(i, "u", f"page {i} " * 50) for i in range(60)], package_bytes=4000)
    assert packages.count() > 5 and sorted(r["page_id"] for r in back.collect()) == list(range(60))


def test_empty_table(stored):
    packages, back = stored([])
    assert packages.count() == 0 and back.count() == 0


def package(records=3):
    writer = warc.PackageWriter()
    for i in range(records):
        writer.add(i, warc.make_record(i, "u", b"body %d" % i, hashlib.sha1(b"body %d" % i).hexdigest(), None))
    out = io.BytesIO()
    writer.write(out)
    return out.getvalue()


def payloads(data):
    reader = warc.PackageReader(io.BytesIO(data), len(data))
    return [warc.parse_record(reader.record(*at))[2] for at in reader.index()]


def test_packages_are_plain_zip_files():
    with zipfile.ZipFile(io.BytesIO(package())) as z:
        assert set(z.namelist()) == {warc.DATA, warc.INDEX} and z.testzip() is None


def test_zip64_directories(monkeypatch):
    usual = payloads(package())
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)  # every size and offset overflows
    data = package()
    assert warc.END64 in data and warc.LOCATOR64 in data
    assert payloads(data) == usual == [b"body 0", b"body 1", b"body 2"]


def test_a_comment_at_the_end():
    data = package()
    at = data.rfind(warc.END)
    assert payloads(data[: at + 20] + struct.pack("<H", 5) + b"hello") == payloads(data)


def test_damage_is_noticed():
    data = package()
    with pytest.raises(ValueError):
        warc.PackageReader(io.BytesIO(data[:-30]), len(data) - 30)
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(warc.DATA, b"x" * 1000)
    with pytest.raises(ValueError, match="compressed"):
        warc.PackageReader(packed, packed.tell())


def test_only_ranges_are_read():
    data = package(200)

    class Counted(io.BytesIO):
        total = 0

        def read(self, n=-1):
            out = super().read(n)
            Counted.total += len(out)
            return out

    reader = warc.PackageReader(Counted(data), len(data))
    before, (offset, length) = Counted.total, list(reader.index())[150]
    before = Counted.total
    reader.record(offset, length)
    assert Counted.total - before == length


def test_packages_are_read_in_parallel(stored):
    """Each package has a task, as far as there are four times as many packages as cores."""
    rows = [(i, "u", f"{i} " * 300) for i in range(60)]
    packages, back = stored(rows, package_bytes=2_000)
    spark = back.sparkSession
    tasks = min(packages.count(), warc.READ_WAVES * spark.sparkContext.defaultParallelism)
    filled = back.groupBy(F.spark_partition_id()).count().count()
    assert packages.count() > 8 and back.rdd.getNumPartitions() == tasks and filled > tasks / 2
    assert back.count() == 60
