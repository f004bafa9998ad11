"""Archives: round trip, revisits, predicates, plain files and members without a skip length."""

import hashlib
import io
import zlib

import pytest
from formline.llm import warc
from formline.session import checkpoint_dir

PAGES = [
    (1, "http://a/1\nx", "long " * 40), (2, "http://a/2", "long " * 40), (3, None, "short"), (4, "http://b", "short"), (5, "http://b/é", None),
    (6, "http://b", "long " * 40), (7, "http://c", "é" * 60), (8, "http://c", "a\r\n\r\nb" * 30), (2, "http://a/2", "long " * 40), (None, "http://n", "long " * 40),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, record_type int")


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write(warc.as_records(pages(spark)), path, fileBytes=600)
    assert len(list((tmp_path / "archive").glob("*.warc.gz"))) > 1
    rows = warc.read(spark, path).filter("record_type <> 'warcinfo'").collect()
    assert len(rows) == len(PAGES)
    responses = {r.record_id: bytes(r.payload) for r in rows if r.record_type == "response"}
    for page, url, html in PAGES:
        if page in (1, 3, 4, 5, 7, 8):
            assert responses[f"<urn:page:{page}>"] == (html or "").encode()
    found = warc.resolve_revisits(warc.read(spark, path), warc.read(spark, path, payload="false")).collect()
    revisits = sorted((r.record_id, r.refers_to, r.payload_bytes) for r in found if r.record_type == "revisit")
    assert [r for r in revisits if "uuid" not in r[0]] == [("<urn:page:2>", "<urn:page:1>", 200)] * 2 + [("<urn:page:6>", "<urn:page:1>", 200)]
    assert len(revisits) == 4
    assert {r.payload_digest for r in found if r.payload_bytes == 200} == {hashlib.sha256(b"long " * 40).hexdigest()}


def test_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write(warc.as_records(pages(spark, [])), path)
    assert warc.read(spark, path).filter("record_type <> 'warcinfo'").count() == 0


def test_predicates_reach_the_reader(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write(warc.as_records(pages(spark)), path)
    some = warc.read(spark, path).filter("record_type = 'response' and target_uri like 'http://b%'")
    assert sorted(r.record_id for r in some.collect()) == ["<urn:page:4>", "<urn:page:5>"]
    bare = warc.read(spark, path, payload="false").filter("record_type = 'response'").collect()
    assert bare and all(r.payload is None and r.content_length > 0 for r in bare)


def test_only_wanted_blocks_are_unpacked():
    record = lambda kind, body: warc.record_bytes({"record_type": kind, "record_id": "<x>"}, body)
    bodies = [b"", b"abc\r\n\r\nd", b"z" * 300_000, b"last"]
    plain = b"".join(record("resource", b) for b in bodies)
    skipping = b"".join(warc.member(record("resource", b), 1) for b in bodies)
    without = b"".join(zlib.compress(record("resource", b), 6, 31) for b in bodies)
    for data in (plain, skipping, without, skipping + plain):
        rows = list(warc.records(io.BytesIO(data)))
        assert [r["payload"] for r in rows] == bodies * (len(rows) // len(bodies)) and rows
        assert [r["payload"] for r in warc.records(io.BytesIO(data), decode=False)] == [None] * len(rows)
        assert list(warc.records(io.BytesIO(data), keep=lambda r: r["record_type"] == "response")) == []
    broken = bytearray(skipping)
    at = len(warc.member(record("resource", b""), 1)) + len(warc.member(record("resource", bodies[1]), 1))
    for i in range(at + 3000, at + 3000 + 20):
        if i < len(broken):
            broken[i] ^= 255  # inside the long block, which nobody reads
    assert len(list(warc.records(io.BytesIO(bytes(broken)), keep=lambda r: False))) == 0


def test_every_record_of_a_member():
    """Several records in one member, records over members' borders, plain parts between, and a file that ends too early."""
    bodies = [b"", b"abc\r\n\r\nd", b"z" * 300_000, b"line\n" * 1000, b"last"]
    record = lambda k, body: warc.record_bytes({"record_type": "resource", "record_id": f"<{k}>", "target_uri": f"u{k}"}, body)
    plain = b"".join(record(k, b) for k, b in enumerate(bodies))
    one = zlib.compress(plain, 6, 31)
    cut = [zlib.compress(plain[i : i + 1777], 6, 31) for i in range(0, len(plain), 1777)]
    empty = zlib.compress(b"", 6, 31)
    skipping = b"".join(warc.member(record(k, b), 1) for k, b in enumerate(bodies))
    for data, times in ((one, 1), (b"".join(cut), 1), (one + one, 2), (plain + one + plain, 3), (empty + one + empty, 1), (one + skipping, 2), (skipping + one, 2)):
        rows = list(warc.records(io.BytesIO(data)))
        assert [r["payload"] for r in rows] == bodies * times
        some = list(warc.records(io.BytesIO(data), keep=lambda r: r["target_uri"] in ("u1", "u4")))
        assert [r["payload"] for r in some] == [bodies[1], bodies[4]] * times
        assert len(list(warc.records(io.BytesIO(data), decode=False))) == 5 * times
    places = [r["offset"] for r in warc.records(io.BytesIO(plain + one))]
    assert places[:2] == [0, len(record(0, b""))] and places[5:] == [len(plain)] * 5
    starts = [0, *(sum(map(len, cut[: i + 1])) for i in range(len(cut)))]
    assert all(r["offset"] in starts for r in warc.records(io.BytesIO(b"".join(cut))))
    for broken in (one[:-9], b"".join(cut)[:-30]):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(broken)))


def test_a_large_block_is_not_kept():
    """50 MB that nobody wants pass in pieces."""
    import tracemalloc

    data = zlib.compress(warc.record_bytes({"record_type": "resource", "record_id": "<1>"}, bytes(50 << 20)) + warc.record_bytes({"record_type": "response", "record_id": "<2>"}, b"x"), 6, 31)
    tracemalloc.start()
    rows = list(warc.records(io.BytesIO(data), keep=lambda r: r["record_type"] == "response"))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r["record_id"] for r in rows] == ["<2>"] and most < 4 << 20


def test_checkpoint_folder_is_shared(spark):
    assert checkpoint_dir(spark)
