import gzip
import hashlib
import io

import pyarrow.fs as pafs
import pytest
from compare import connect, differences
from conftest import DATA
from rows import bag

from partyfold.llm import queries, warc

PAGES = "page_id bigint, url string, html string, payload string, digest int"
LONG = "x" * 100


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, None, 0) for i, u, h in rows], PAGES)


def plain(rows):
    first = {}
    for i, _, h in rows:
        if h and len(h.encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    result = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and i != first.get(h)
        result.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    return result


ROWS = [
    (3, "http://a", LONG), (1, "http://b\r\nx: y", LONG), (2, None, LONG), (4, "http://c", "short"),
    (5, "http://c", "short"), (6, "", None), (7, "u", ""), (8, "ü", "é\r\n\r\nñ" * 40), (1, "http://b", LONG),
    (9, "v", "HTTP/1.1 200\r\n\r\n" + "WARC/1.1\r\n" * 30), (10, "w", "long " * 100_000), (None, "n", LONG),
]


def test_pages_come_back(spark):
    found = warc.archived_pages(warc.archive(pages(spark, ROWS).repartition(3)))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, plain(ROWS)))
    assert warc.archived_pages(warc.archive(pages(spark, []))).count() == 0


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_predicates_are_pushed_and_payloads_left_alone(spark, tmp_path, compression):
    warc.register(spark)
    path = str(tmp_path / "archive")
    records = warc.page_records(pages(spark, ROWS)).repartition(2)
    records.write.format("warc").option("compression", compression).option("fileBytes", 500).mode("append").save(path)
    scan = spark.read.format("warc").load(path)
    revisits = scan.where("record_type = 'revisit' and record_id in ('<urn:page:2>', '<urn:page:9>')")
    assert [r["refers_to"] for r in revisits.collect()] == ["<urn:page:1>"]
    assert scan.where("target_uri like 'http%'").count() == 5
    assert scan.where("refers_to is null").count() == 9
    assert scan.where("payload_bytes < 10").count() == 4
    bare = spark.read.format("warc").option("payload", "false").load(path)
    assert {r["payload"] for r in bare.where("record_type = 'response'").collect()} == {None}
    one = spark.read.format("warc").option("partitionBytes", 1).load(path)
    assert bag(one.select("record_id", "payload_digest")) == bag(scan.select("record_id", "payload_digest"))


def record(**fields):
    return warc.record_bytes({"record_type": "response", "record_id": "<r>", **fields})


class Counting:
    """A file that knows how many bytes were read."""

    def __init__(self, raw):
        self._inner, self._size, self.read_bytes = io.BytesIO(raw), len(raw), 0

    def size(self):
        return self._size

    def seek(self, at):
        self._inner.seek(at)

    def read(self, n):
        data = self._inner.read(n)
        self.read_bytes += len(data)
        return data


def noise(n):
    return hashlib.shake_256(b"seed").digest(n)


@pytest.mark.parametrize("compressed", [True, False])
def test_unwanted_payloads_are_stepped_over(compressed):
    payload = noise(1 << 20)
    plain_records = [record(payload=payload, record_id=f"<{k}>") for k in range(5)]
    raw = b"".join(map(warc.gzip_member, plain_records) if compressed else plain_records)
    source = Counting(raw)
    seen = [(h["warc-record-id"], block) for h, block in warc.records(source)]
    assert [name for name, _ in seen] == [f"<{k}>" for k in range(5)]
    assert source.read_bytes < len(raw) / 5
    assert warc.split_http(seen[3][1]())[1] == payload


def test_other_peoples_gzip_members_are_read():
    raw = b"".join(gzip.compress(record(payload=noise(100_000), record_id=f"<{k}>")) for k in range(4))
    found = [(h["warc-record-id"], warc.split_http(block())[1]) for h, block in warc.records(Counting(raw))]
    assert [f[0] for f in found] == ["<0>", "<1>", "<2>", "<3>"]
    assert all(f[1] == noise(100_000) for f in found)
    assert gzip.decompress(warc.gzip_member(b"abc" * 1000)) == b"abc" * 1000


def test_what_the_manifest_does_not_name_is_not_read(spark, tmp_path):
    warc.register(spark)
    path = str(tmp_path / "archive")
    warc.page_records(pages(spark, ROWS)).write.format("warc").mode("append").save(path)
    count = spark.read.format("warc").load(path).count()
    (tmp_path / "archive" / "left-by-a-lost-task.warc").write_bytes(record(payload=b"y"))
    assert spark.read.format("warc").load(path).count() == count == len(ROWS)
    writer = warc.WarcWriter({"path": path}, overwrite=False)
    writer.abort([warc._Written(["left-by-a-lost-task.warc"])])
    assert pafs.LocalFileSystem().get_file_info(f"{path}/left-by-a-lost-task.warc").type == pafs.FileType.NotFound


def test_the_query_agrees_with_sql(spark):
    sf_dir = str(DATA / "sf0.001")
    with connect(sf_dir) as duck:
        df = queries.QUERIES["op6_warc"](spark, sf_dir)
        assert differences(df, duck, queries.ORACLES["op6_warc"]) == []


def test_every_write_has_a_list_of_its_own(spark, tmp_path):
    warc.register(spark)
    path = str(tmp_path / "archive")
    one, two = (warc.WarcWriter({"path": path}, overwrite=False) for _ in range(2))
    (tmp_path / "archive").mkdir()
    for name in ("a", "b", "c"):
        (tmp_path / "archive" / f"{name}.warc").write_bytes(record(payload=name.encode()))
    one.commit([warc._Written(["a.warc"])])
    two.commit([warc._Written(["b.warc"]), None])
    (tmp_path / "archive" / f"{warc.MANIFEST}-x.unfinished").write_text('["c.warc"')  # a crash in the middle
    scan = spark.read.format("warc").load(path)
    assert scan.count() == 2
    warc.WarcWriter({"path": path}, overwrite=True).commit([warc._Written(["c.warc"])])
    assert spark.read.format("warc").load(path).count() == 1
    assert not (tmp_path / "archive" / "a.warc").exists()


def test_copies_carry_no_payload(spark):
    common = "an error page that many hosts have " * 10
    rows = [(i, f"u{i}", common if i % 3 else f"page {i} " * 50) for i in range(300)]
    found = warc.page_records(pages(spark, rows + [(4, "again", common), (None, "unnamed", common)])).collect()
    revisits = [r for r in found if r["record_type"] == "revisit"]
    assert len(found) == 302 and len(revisits) == 201  # page 1 is the first, the unnamed one revisits it
    assert all(r["payload"] is None and r["refers_to"] == "<urn:page:1>" for r in revisits)
    assert all(r["payload"] is not None for r in found if r["record_type"] == "response")
