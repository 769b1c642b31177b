import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from envgrade.llm import warc
from envgrade.llm.warc import decide, op7_warc, read_warc, records, salvage, write_warc

BIG = "<p>" + "y" * 1200 + "</p>"
PAGES = [
    (1, "http://a.example/1", "<p>small</p>"), (2, "http://a.example/2", "<p>small</p>"), (3, None, BIG), (4, "http://b.example/\r\nX: y", BIG),
    (9, "http://b.example/9", BIG), (5, "http://c.example", None), (6, "http://c.example/6", ""), (9, "http://b.example/9", BIG),
    (None, "http://d.example", "<p>no id</p>"), (7, "http://e.example", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1\r\n" + "z" * 2000),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns(
        {"chosen": F.lit("?"), "block": F.lit("?")}
    )


def _want():
    out = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        best = max((p for p, _, h in PAGES if p is not None and (h or "").encode() == data), default=None)
        revisit = len(data) >= 1000 and page_id is not None and page_id < best
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=repr)


def test_query(spark, pages, write_tables):
    assert sorted((tuple(r) for r in op7_warc(spark, write_tables(pages=pages)).collect()), key=repr) == _want()


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip_of_files(spark, pages, tmp_path, compression):
    write_warc(pages, f"{tmp_path}/w", compression)
    rows = read_warc(spark, f"{tmp_path}/w").collect()
    assert {r["kind"] for r in rows} == {"record"}
    by_id = {r["page_id"]: r for r in rows}
    assert bytes(by_id[7]["payload"]).decode() == PAGES[-1][2]
    assert by_id[3]["payload"] is None and by_id[3]["refers_to"] == 9


def test_empty_table(spark, pages, write_tables):
    assert op7_warc(spark, write_tables(pages=pages.limit(0))).count() == 0


@pytest.fixture(scope="module")
def archive(pages):
    return [bytes(r["value"]) + b"\r\n\r\n" for r in records(decide(pages)).collect()]


def _kinds(data):
    return [(kind, start, stop) for kind, start, stop, *_ in salvage(data)]


def test_salvage_after_damage(archive):
    whole = b"".join(archive)
    assert all(k == "record" for k, _, _ in _kinds(whole)) and len(_kinds(whole)) == len(archive)
    bounds = [(s, e) for _, s, e in _kinds(whole)]
    start, stop = bounds[4]
    for bad in (
        whole[: stop - 20] + b"????" + whole[stop - 16 :],  # damage in the block
        whole[: start + 2] + b"?" + whole[start + 3 :],  # damage in the version line
        whole[: start + 40] + whole[stop - 10 :],  # missing bytes
    ):
        kinds = _kinds(bad)
        assert [k for k, _, _ in kinds].count("record") == len(archive) - 1
        gaps = [(s, e) for k, s, e in kinds if k == "gap"]
        assert len(gaps) == 1 and gaps[0][0] == start
    assert _kinds(b"junk" + whole)[0] == ("gap", 0, 4) and len(_kinds(b"junk" + whole)) == len(archive) + 1
    assert _kinds(whole[:-30])[-1][0] == "gap"
    assert _kinds(b"") == [] and _kinds(b"nothing at all") == [("gap", 0, 14)]


def test_salvage_of_gzip_members(archive):
    members = [gzip.compress(r, mtime=0) for r in archive]
    whole = b"".join(members)
    assert [k for k, _, _ in _kinds(whole)] == ["record"] * len(archive)
    at = len(b"".join(members[:3]))
    bad = bytearray(whole)
    bad[at + 30] ^= 255
    kinds = _kinds(bytes(bad))
    assert [k for k, _, _ in kinds].count("record") == len(archive) - 1
    assert [(s, e) for k, s, e in kinds if k == "gap"] == [(at, at + len(members[3]))]


def _files(folder):
    return sorted(p for p in folder.iterdir() if p.name.startswith("part-"))


def test_a_damaged_member_of_a_file_loses_one_record(spark, pages, tmp_path):
    write_warc(pages.coalesce(1), f"{tmp_path}/w", "gzip")
    (file,) = _files(tmp_path / "w")
    data = bytearray(file.read_bytes())
    whole = _kinds(bytes(data))
    assert [k for k, _, _ in whole] == ["record"] * len(PAGES)
    _, start, stop = whole[4]
    data[(start + stop) // 2] ^= 255
    damaged = tmp_path / "d" / "part-0.warc.gz"
    damaged.parent.mkdir()
    damaged.write_bytes(data)
    rows = read_warc(spark, str(damaged.parent)).collect()
    assert sorted(r["kind"] for r in rows) == ["gap"] + ["record"] * (len(PAGES) - 1)
    assert [r["start"] for r in rows if r["kind"] == "gap"] == [start]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_files_are_bounded_in_bytes(spark, tmp_path, monkeypatch, compression):
    monkeypatch.setattr(warc, "CLASSES", (200, 3000, 40000))
    monkeypatch.setattr(warc, "FILE_BYTES", 60000)
    sizes = [10] * 40 + [2500] * 60 + [30000] * 5 + [200000] * 2
    rows = [(i, "http://a.example", f"{i:06d}" + "q" * n) for i, n in enumerate(sizes)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    write_warc(made, f"{tmp_path}/w", compression)
    found = [p.stat().st_size for p in _files(tmp_path / "w")]
    largest = 201000 if compression == "none" else 60000
    assert max(found) <= largest and len(found) >= 10
    if compression == "none":
        assert sorted(found)[-3] <= 60000 + 20 * 700 and sum(f > 80000 for f in found) == 2
    back = {r["page_id"]: r for r in read_warc(spark, f"{tmp_path}/w").collect()}
    assert {i: bytes(r["payload"]).decode() for i, r in back.items()} == {i: html for i, _, html in rows}


def test_other_compressions_are_refused(pages, tmp_path):
    with pytest.raises(ValueError, match="compression"):
        write_warc(pages, f"{tmp_path}/w", "bzip2")
