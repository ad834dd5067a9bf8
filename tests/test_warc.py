import gzip

import pytest

from corpusloom.sources import warc
from tests.conftest import rows

HTML = "<!DOCTYPE html>\r\n<p>WARC/1.0 inline</p>\rend"


def record(body: bytes, uri="http://a/", kind="response", rid="r1", http="text/html", length=None):
    if http:
        body = f"HTTP/1.1 200 OK\r\nX: y\r\ncontent-type: {http}\r\n\r\n".encode() + body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\n"
    head += f"WARC-Target-URI: {uri}\r\n" if uri else ""
    head += f"WARC-Record-ID: <urn:uuid:{rid}>\r\n" if rid else ""
    head += f"Content-Length: {len(body) if length is None else length}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def write(path, *records):
    """One gzip member per record."""
    path.write_bytes(b"".join(gzip.compress(r) for r in records) or gzip.compress(b""))
    return str(path)


@pytest.fixture
def archives(tmp_path):
    one = write(
        tmp_path / "a.warc.gz",
        record(b"software: x\r\n", uri=None, kind="warcinfo", rid="info", http=None),
        record(HTML.encode(), rid="html"),
        record("<p>čaj</p>".encode(), uri="http://b/?q=1", rid="utf8", http="text/html; charset=UTF-8"),
        record("<p>caf\xe9</p>".encode("latin-1"), rid="latin"),
        record(b"plain", rid="plain", http="text/plain"),
        record(b"", rid="empty"),
        record(b"one\r\n\r\ntwo\r\n\r\n", rid="gaps"),
    )
    return [one, write(tmp_path / "empty.warc.gz")]


@pytest.mark.parametrize("framing", ["separator", "length"])
def test_records(spark, archives, framing):
    df = warc.read_warc(spark, archives, framing, check=True)
    got = {r.doc_id: r for r in df.collect()}
    assert set(got) == {"info", "html", "utf8", "latin", "plain", "empty", "gaps"}
    assert got["info"].uri == "Unknown" and got["info"].content_type == "unknown"
    assert got["html"].payload == HTML.replace("\r\n", "\n").replace("\r", "\n")
    assert got["html"].content_type == "text/html" and got["html"].uri == "http://a/"
    assert got["utf8"].payload == "<p>čaj</p>" and got["utf8"].uri == "http://b/?q=1"
    assert got["latin"].payload == "<p>caf�</p>"
    # The text source keeps the bytes, so their number can still be compared.
    assert got["latin"].framing == {"separator": "ok", "length": "unknown"}[framing]
    assert got["empty"].payload == ""
    assert got["gaps"].payload == "one\n\ntwo\n\n"
    assert {r.framing for k, r in got.items() if k != "latin"} == {"ok"}


def test_record_type_filter(spark, archives):
    assert "info" not in {r[0] for r in rows(warc.read_warc(spark, archives, warc_type="response"), "doc_id")}


def test_body_with_the_exact_separator(spark, tmp_path):
    path = write(tmp_path / "s.warc.gz", record(b"a\r\n\r\nWARC/1.0\r\nb", rid="x"), record(b"c", rid="y"))
    exact = warc.read_warc(spark, path, "length")
    assert rows(exact, "doc_id", "payload") == [("x", "a\n\nWARC/1.0\nb"), ("y", "c")]
    cut = warc.read_warc(spark, path, "separator", check=True)
    assert "mismatch" in {r[0] for r in rows(cut, "framing")}


@pytest.mark.parametrize("framing", ["separator", "length"])
def test_versions_mix(spark, tmp_path, framing):
    new = record(b"b", rid="b").replace(b"WARC/1.0", b"WARC/1.1")
    path = write(tmp_path / "v.warc.gz", new, record(b"a", rid="a"), new.replace(b":b>", b":c>"), record(b"d", rid="d"))
    got = rows(warc.read_warc(spark, path, framing, check=True), "doc_id", "payload", "framing")
    assert got == [("a", "a", "ok"), ("b", "b", "ok"), ("c", "b", "ok"), ("d", "d", "ok")]


@pytest.mark.parametrize("framing", ["separator", "length"])
def test_records_without_a_length_are_kept(spark, tmp_path, framing):
    none = record(b"x\r\ny", rid="n", http=None).replace(b"Content-Length: 4\r\n", b"")
    odd = record(b"z", rid="o", http=None, length="many")
    path = write(tmp_path / "l.warc.gz", none, odd, record(b"a", rid="a"))
    got = rows(warc.read_warc(spark, path, framing, check=True), "doc_id", "payload", "framing")
    assert got == [("a", "a", "ok"), ("n", "x\ny", "bad"), ("o", "z", "bad")]


def test_folders_and_globs(spark, tmp_path):
    for name in ("a", "b"):
        write(tmp_path / f"{name}.warc.gz", record(name.encode(), rid=name))
    for path in (str(tmp_path), f"{tmp_path}/*.warc.gz"):
        df = warc.read_warc(spark, path)
        assert rows(df, "doc_id") == [("a",), ("b",)] and df.rdd.getNumPartitions() == 2


def test_missing_id_is_stable(spark, tmp_path):
    path = write(tmp_path / "n.warc.gz", record(b"a", rid=None), record(b"b", rid=None))
    ids = rows(warc.read_warc(spark, path), "doc_id")
    assert ids == rows(warc.read_warc(spark, path), "doc_id") and len(set(ids)) == 2


def test_manifests(spark, tmp_path):
    (tmp_path / "warcfiles").mkdir()
    write(tmp_path / "warcfiles" / "a.gz", record(b"a", rid="a"))
    write(tmp_path / "warcfiles" / "b.gz", record(b"b", rid="b"))
    for name, body in (("m1", "a.gz\n\n"), ("m2", "b.gz")):
        (tmp_path / name).write_text(body)
    paths = warc.read_manifests(spark, f"{tmp_path}/m1; {tmp_path}/m2;")
    assert rows(warc.read_warc(spark, paths), "doc_id") == [("a",), ("b",)]


def test_stream(spark, archives, tmp_path):
    out = str(tmp_path / "out")
    df = warc.read_warc_stream(spark, f"{tmp_path}/*.warc.gz", framing="separator")
    run = df.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
    run.trigger(availableNow=True).start(out).awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(warc.read_warc(spark, archives, "separator"))


def test_unknown_framing(spark):
    with pytest.raises(ValueError):
        warc.read_warc(spark, "x", framing="other")


def _record(i, body):
    head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:r{i}>\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def test_split_archives_equal_the_sequential_read(spark, tmp_path):
    import gzip as gz
    import random as rnd

    from corpusloom.sources import warc as w

    rng = rnd.Random(4)
    records = [_record(i, (f"HTTP/1.1 200 OK\r\n\r\nbody {i} " + "x" * rng.randrange(0, 3000)).encode()
                       + (b"\r\n\r\nWARC/1.0\r\nnot a record" if i % 7 == 0 else b"")) for i in range(1000)]
    per_record = tmp_path / "a.warc.gz"
    per_record.write_bytes(b"".join(gz.compress(r) for r in records))
    blob = b"".join(records)  # members cut through records: 5,000 bytes each
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gz.compress(blob[i:i + 5000]) for i in range(0, len(blob), 5000)))
    (tmp_path / "c.warc.gz").write_bytes(gz.compress(blob))  # one member: one split
    want = []
    for name in ("a", "b", "c"):
        with gz.open(tmp_path / f"{name}.warc.gz") as stream:
            want += [(v, name) for v in w.framed(stream)]
    raw = w.length_records(spark, [str(tmp_path)], split_bytes=10_000)
    got = [(r.value, r.file.rsplit("/", 1)[1][0]) for r in raw.collect()]
    assert sorted(got) == sorted(want) and len(want) == 3000
    assert raw.rdd.getNumPartitions() >= 8
    with open(per_record, "rb") as raw_file:
        assert len(list(w.member_offsets(raw_file))) == 1000


def test_stream_frames_by_length(spark, tmp_path):
    """A body that holds the separator stays one record in the stream, as in the batch read."""
    import gzip as gz

    from corpusloom.sources import warc as w

    folder = tmp_path / "in"
    folder.mkdir()
    records = [_record(i, f"HTTP/1.1 200 OK\r\n\r\nbody {i}\r\n\r\nWARC/1.0\r\nfake: yes".encode()) for i in range(30)]
    (folder / "a.warc.gz").write_bytes(b"".join(gz.compress(r) for r in records[:20]))
    (folder / "b.warc.gz").write_bytes(gz.compress(b"".join(records[20:])))
    out = str(tmp_path / "out")
    stream = w.read_warc_stream(spark, str(folder), check=True)
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")) \
        .trigger(availableNow=True).start(out).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, w.read_warc(spark, str(folder), check=True).collect()))
    assert got.count() == 30 and got.where("framing = 'ok'").count() == 30
