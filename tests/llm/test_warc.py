import hashlib

import pytest
from pyspark.sql import functions as F

from cohortframe.llm import warc as W

PAGES = "page_id long, url string, html string"


def slow(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= W.MIN_REVISIT and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = b in first and (i is None or i > first[b])
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(map(str, out))


def rows():
    long = "<p>é" + "x" * 200
    out = [(i, f"http://h/{i}", f"<p>page {i}</p>") for i in range(30)]
    out += [(40, "http://a", long), (35, None, long), (99, "http://b\r\nX: y", long), (35, None, long), (None, "", long), (50, "u", "short"), (51, "u", "short"),
            (60, "u", None), (61, "u", ""), (62, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (63, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (64, "u", "z" * 3_000_000), (65, "u", "a\x00b\x1f" * 50)]
    return out


@pytest.mark.parametrize("gap,run,head", [(W.GAP, W.RUN, W.HEAD), (0, 1, 64)])
def test_round_trip_matches_brute_force(spark, tmp_path, monkeypatch, gap, run, head):
    monkeypatch.setattr(W, "GAP", gap)
    monkeypatch.setattr(W, "RUN", run)
    monkeypatch.setattr(W, "HEAD", head)
    df = spark.createDataFrame(rows(), PAGES).withColumns({"digest": F.lit("x"), "id": F.lit(1), "payload": F.lit(2)})
    W.write_archive(df.repartition(3), str(tmp_path / "w"))
    index = W.build_index(spark, str(tmp_path / "w"))
    assert index.count() == len(rows())
    got = W.captures(W.read_records(index)).collect()
    assert sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in got) == slow(rows())


def test_selected_records_are_read_alone(spark, tmp_path):
    W.write_archive(spark.createDataFrame(rows(), PAGES), str(tmp_path / "w"))
    index = W.build_index(spark, str(tmp_path / "w"))
    some = W.read_records(index.filter("url = 'http://h/7' or record_id = '<urn:page:64>'")).collect()
    assert sorted(len(r["payload"]) for r in some) == [len("<p>page 7</p>"), 3_000_000]
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["digest"] for r in some)


def test_urls_stay_on_their_line(spark, tmp_path):
    W.write_archive(spark.createDataFrame(rows(), PAGES), str(tmp_path / "w"))
    urls = {r["record_id"]: r["url"] for r in W.build_index(spark, str(tmp_path / "w")).collect()}
    assert urls["<urn:page:99>"] == "http://b%0D%0AX: y" and urls["<urn:page:35>"] is None and urls["<urn:page:null>"] == ""


def test_empty_table_and_broken_archive(spark, tmp_path):
    W.write_archive(spark.createDataFrame([], PAGES), str(tmp_path / "e"))
    assert W.captures(W.read_records(W.build_index(spark, str(tmp_path / "e")))).collect() == []
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.txt").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha256:0\r\nContent-Length: 99\r\n\r\nabc")
    with pytest.raises(Exception, match="cut off"):
        W.build_index(spark, str(tmp_path / "b"))
