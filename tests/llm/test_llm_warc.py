import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from tickloom.llm import warc

PAGES = "page_id long, url string, html string, payload string"
ROWS = [
    (1, "http://a", "<p>é\r\n\r\nWARC/1.1</p>"), (2, "http://b", "<p>é\r\n\r\nWARC/1.1</p>"), (3, None, None), (4, "u\r\nX: y", ""),
    (5, "http://c", "x" * 900_000), (6, "http://d", "x" * 900_000), (7, "http://e", "one"), (None, "http://f", "one"), (7, "http://e", "one"),
    (8, "http://g", "漢\n"),
]


def brute(rows, least=0):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        revisit = page_id is not None and len(data) >= least and page_id < max(same)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id or 0, len(data), digest, "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=str)


def collected(frame):
    return sorted(((r.page_id or 0, *r[1:]) for r in frame.collect()), key=str)


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*row, "clash") for row in ROWS], PAGES)
    assert collected(warc.through_archives(pages, least)) == brute(ROWS, least)


def test_members_and_index(spark, folder):
    pages = spark.createDataFrame([(*row, "clash") for row in ROWS], PAGES)
    warc.write_monolithic(warc.with_revisits(pages), f"{folder}/whole")
    index = warc.normalise(spark, f"{folder}/whole", f"{folder}/members").collect()
    assert len(index) == len(ROWS)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(folder, "whole").glob("*.gz")))
    one_by_one = []
    for row in sorted(index, key=lambda r: (r.file, r.offset)):
        data = Path(folder, "members", row.file).read_bytes()[row.offset : row.offset + row.length]
        one_by_one.append(gzip.decompress(data))
        assert one_by_one[-1].startswith(b"WARC/1.1\r\n")
    assert b"".join(one_by_one) == whole
    assert not list(Path(folder, "members").glob(".*.new"))


def test_stream_of_several_members_and_a_cut_one():
    records = [f"WARC/1.1\r\nContent-Length: {n}\r\n\r\n{'z' * n}\r\n\r\n".encode() for n in (0, 5, 700_000)]
    stream = gzip.compress(records[0] + records[1]) + gzip.compress(records[2])
    assert list(warc.inflated(iter([stream[:7], stream[7:]]))) == records
    with pytest.raises(ValueError):
        list(warc.inflated(iter([gzip.compress(records[1][:-3])])))


def test_empty(spark):
    assert warc.through_archives(spark.createDataFrame([], PAGES)).count() == 0


def test_no_payload_is_shuffled(spark, folder):
    pages = spark.range(4_000).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(string(id div 2), 512), 20) AS html")
    found = warc.with_revisits(pages)
    warc.write_monolithic(found, f"{folder}/whole")
    warc.normalise(spark, f"{folder}/whole", f"{folder}/members")
    back = warc.read_archives(spark, f"{folder}/members")
    assert "Exchange" not in back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == 4_000
    # every task that has records writes an archive of them
    assert len(list(Path(folder, "whole").glob("*.gz"))) == found.rdd.getNumPartitions()


def test_an_archive_and_its_sidecar_belong_together(spark, folder):
    pages = spark.createDataFrame([(*row, "clash") for row in ROWS], PAGES)
    warc.write_monolithic(warc.with_revisits(pages).coalesce(1), f"{folder}/whole")
    warc.normalise(spark, f"{folder}/whole", f"{folder}/members")
    (one,) = Path(folder, "members").glob("*.idx")
    for name in (one.name, one.name.replace(".idx", ".warc.gz")):
        lone = Path(folder, f"lone-{name}")
        lone.mkdir()
        (lone / name).write_bytes(Path(folder, "members", name).read_bytes())
        with pytest.raises(Exception, match="No such file|Failed to open"):
            warc.read_archives(spark, str(lone)).collect()
