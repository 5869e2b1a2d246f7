"""Archives as files: members, rolling, identifiers, revisits, damage, and captures of several records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter
from pathlib import Path

import pytest

from helixframe.llm import warc

SCHEMA = "page_id long, url string, html string"


def archive(spark, tmp_path, rows, **options):  # noqa: ANN001, ANN201
    path = f"file://{tmp_path}/warc"
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path, **options)
    return path, sorted(Path(f"{tmp_path}/warc").glob("*.warc.gz"))


def test_a_member_a_record_and_files_of_bounded_size(spark, tmp_path):
    rng = random.Random(0)
    rows = [(k, f"http://h/{k}", "".join(rng.choice("abcdefgh <>") for _ in range(4000))) for k in range(200)]
    path, files = archive(spark, tmp_path, rows, archive_bytes=50_000)
    assert len(files) > 4 and max(f.stat().st_size for f in files) < 60_000
    n = 0
    for f in files:
        with f.open("rb") as stream:
            found = list(warc.members(stream, 777))
        assert found[0].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        assert gzip.decompress(f.read_bytes()) == b"".join(found) and all(x.endswith(b"\r\n\r\n") for x in found)
        n += len(found) - 1
    assert n == 600 == warc.read_records(spark, path).count()


def test_identifiers_and_revisits(spark, tmp_path):
    rows = [(5, "http://a/", "same"), (3, "http://b/", "same"), (9, "u\r\nv", "same"), (None, "http://n/", "same"), (None, None, None), (None, "x", ""), (7, "x", "own"), (7, "x", "own"), (8, "y", "own"), (20, "long", "é" * 500_000)]
    path, _ = archive(spark, tmp_path, rows)
    records = warc.read_records(spark, path).collect()
    assert len({r.record_id for r in records}) == 3 * len(rows)
    by_id = {r.record_id: r for r in records}
    got = warc.transactions(warc.read_records(spark, path)).collect()
    assert len(got) == len(rows) and all(len(r.request) == 1 and len(r.metadata) == 1 for r in got)
    want = Counter({(5, "revisit", "3"): 1, (3, "response", None): 1, (9, "revisit", "3"): 1, (None, "revisit", "3"): 1, (None, "response", None): 2, (7, "response", None): 2, (8, "revisit", "7"): 1, (20, "response", None): 1})
    assert Counter((r.response.page_id, r.response.warc_type, r.response.refers_to) for r in got) == want
    for r in got:
        if r.response.refers_to == "3":
            assert by_id[r.response.refers_to_id].page_id == 3 and by_id[r.response.refers_to_id].target == "http://b/"
        if r.response.warc_type == "response":
            assert base64.b32encode(hashlib.sha1(r.response.block).digest()).decode() == r.response.payload_digest
            assert r.response.http_head.startswith("HTTP/1.1 200 OK\r\n") and f"Content-Length: {len(r.response.block)}\r\n" in r.response.http_head
        else:
            assert bytes(r.response.block) == b""
    assert next(r for r in got if r.response.page_id == 9).response.target == "u%0D%0Av"


def test_small_payloads_revisit_nothing(spark, tmp_path):
    path, _ = archive(spark, tmp_path, [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "xxxx"), (4, "d", "xxxx")], least=3)
    got = {r.response.page_id: r.response.warc_type for r in warc.transactions(warc.read_records(spark, path)).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_files_of_attempts_that_do_not_count_are_not_read(spark, tmp_path):
    path, files = archive(spark, tmp_path, [(1, "a", "xx")])
    files[0].with_name("part-000000-0000-999.warc.gz").write_bytes(files[0].read_bytes())
    assert warc.read_records(spark, path).count() == 3


def test_damage_is_an_error(spark, tmp_path):
    path, files = archive(spark, tmp_path, [(1, "a", "payload")])
    with files[0].open("rb") as stream:
        found = list(warc.members(stream))
    files[0].write_bytes(b"".join(gzip.compress(x.replace(b"payload", b"Payload") if b"response\r\n" in x else x) for x in found))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_records(spark, path).collect()
    files[0].write_bytes(gzip.compress(found[0])[:-3])
    with pytest.raises(Exception, match="truncated"):
        warc.read_records(spark, path).collect()


def test_captures_of_several_records(spark):
    def row(name: str, kind: str, of: list[str] | None) -> tuple:
        return (name, kind, "t", of, None, None, 1, None, b"", None, None, None)

    rows = [row("r1", "response", None), row("r2", "revisit", None), row("q1", "request", ["r1"]), row("m1", "metadata", ["r1", "q1", "r1"]), row("m2", "metadata", ["r2", "r1"]), row("q9", "request", ["gone"]), row("m8", "metadata", None)]
    got = {r.capture_id: ([x.record_id for x in r.request], r.response.warc_type, [x.record_id for x in r.metadata]) for r in warc.transactions(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert got == {"r1": (["q1"], "response", ["m1", "m2"]), "r2": ([], "revisit", ["m2"])}


def test_a_large_archive_is_streamed(tmp_path):
    """200 MB in one archive: a reader holds a record and a piece of the file."""
    f, block = tmp_path / "large.warc.gz", random.Random(1).randbytes(1 << 20)
    with f.open("wb") as out:
        for k in range(200):
            z = zlib.compressobj(1, zlib.DEFLATED, 31)
            out.write(z.compress(f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <{k}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n") + z.flush())
    import tracemalloc

    tracemalloc.start()
    with f.open("rb") as stream:
        assert sum(warc.parse(x)[1] == block for x in warc.members(stream)) == 200
    assert tracemalloc.get_traced_memory()[1] < 30 << 20
    tracemalloc.stop()
