import base64
import gzip
import hashlib
import io

import pytest

from pricegrid.llm import warc


def make(rows, spark):
    shape = "page_id long, url string, html string, content string, key string"
    return spark.createDataFrame([(*r, "c", "k") for r in rows], shape)


ROWS = [
    (1, "http://a/é ü", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://c", ""),
    (5, "http://d", "é\r\n\r\nWARC/1.1\r\n"), (6, "http://e", "y" * 400_000), (None, "http://f", "same"),
    (7, "http://g", "seven"), (7, "http://g", "seven"), (8, "http://h", "Same"),
]


def brute(rows, least=0):
    best = {}
    for i, _, h in rows:
        if i is not None:
            best[h or ""] = max(best.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = best.get(h or "")
        revisit = len(raw) >= least and first is not None and i != first
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("least", [0, 5])
@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 100])
def test_round_trip(spark, least, archive_bytes):
    archives = warc.write_archives(make(ROWS, spark), least, archive_bytes)
    records = warc.checked_revisits(warc.read_archives(archives))
    got = records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(str(tuple(r)) for r in got) == brute(ROWS, least)
    for r in records.where("record_type = 'response'").collect():
        assert bytes(r.content).decode() in {h or "" for i, _, h in ROWS if i == r.page_id}


def test_empty_table(spark):
    assert warc.read_archives(warc.write_archives(make([], spark))).count() == 0


def archive(*payloads):
    parts = [
        warc.gzip_member(warc.record_bytes(k, "http://x", p, warc.payload_digest(p), len(p), None, False))
        for k, p in enumerate(payloads)
    ]
    return b"".join(parts)


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_reader_streams_members_in_any_step(chunk):
    payloads = [b"", b"a\r\n\r\nb", b"z" * 100_000, bytes(range(256)) * 40]
    got = [b"".join(block) for _, block in warc.Records(io.BytesIO(archive(*payloads)).read, chunk)]
    assert got == payloads
    heads = [h["content-length"] for h, _ in warc.Records(io.BytesIO(archive(*payloads)).read, chunk)]
    assert heads == [str(len(p)) for p in payloads]  # blocks that nobody reads are skipped


def test_each_record_is_a_gzip_member_of_its_own():
    data = archive(b"one", b"two")
    assert gzip.decompress(data).count(b"WARC/1.1") == 2 and data.count(b"\x1f\x8b\x08") == 2


@pytest.mark.parametrize("damage", ["cut", "length", "frame"])
def test_damage_is_an_error(damage):
    data = archive(b"x" * 5000)
    if damage == "cut":
        data = data[:-20]
    elif damage == "length":
        data = warc.gzip_member(gzip.decompress(data).replace(b"Content-Length: 5000", b"Content-Length: 4999"))
    else:
        data = warc.gzip_member(b"HTTP/1.1\r\n\r\n")
    with pytest.raises(ValueError):
        for _, block in warc.Records(io.BytesIO(data).read):
            b"".join(block)


def test_wrong_digest_is_an_error(spark, tmp_path):
    path = tmp_path / "bad.warc.gz"
    path.write_bytes(warc.gzip_member(warc.record_bytes(1, "u", b"abc", warc.payload_digest(b"abd"), 3, None, False)))
    bad = spark.createDataFrame([(str(path), 1, 1)], warc._MANIFEST)
    with pytest.raises(Exception, match="digest"):
        warc.read_archives(bad).collect()


def test_revisit_of_nothing_is_an_error(spark):
    row = (1, "u", "revisit", "D", 3, 99, None)
    with pytest.raises(Exception, match="refers to no response"):
        warc.checked_revisits(spark.createDataFrame([row], warc.RECORDS)).collect()


def test_files_are_plain_warc_archives(spark):
    (path,) = {r.archive for r in warc.write_archives(make(ROWS[:2], spark).coalesce(1)).collect()}
    data = open(path.removeprefix("file://"), "rb").read()
    assert data[:3] == b"\x1f\x8b\x08" and gzip.decompress(data).startswith(b"WARC/1.1\r\n")
