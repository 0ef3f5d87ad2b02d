"""WARC: exact round trip, revisits, predicates decided on headers, retried attempts."""

import base64
import collections
import gzip
import hashlib
import io
import os
import zlib

from ledgerline.llm import warc as W


def pages(spark):
    long, other = "é" * 600, "b" * 5000
    rows = [(1, long), (5, long), (3, long), (2, "short"), (4, "short"), (6, None), (7, ""), (8, other),
            (None, other), (9, "z" * 999), (10, "z" * 999), (11, "y" * 1000), (11, "y" * 1000), (12, "y" * 1000),
            (13, "long text " * 30_000)]
    return spark.createDataFrame([(i, h, "u", "p") for i, h in rows],
                                 "page_id long, html string, url string, payload string")


def expected(rows):
    out = []
    data = [(i, (h or "").encode()) for i, h in rows]
    best = {}
    for i, d in data:
        if len(d) >= 1000 and i is not None:
            best[d] = max(best.get(d, i), i)
    for i, d in data:
        again = len(d) >= 1000 and d in best and best[d] != i
        out.append((i, len(d), hashlib.sha1(d).hexdigest(), "revisit" if again else "response",
                    best[d] if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    p = pages(spark)
    got = sorted((tuple(r) for r in W.round_trip(p).collect()), key=repr)
    assert got == expected([(r.page_id, r.html) for r in p.collect()])
    assert W.round_trip(p.limit(0)).count() == 0


def test_reader_prunes_by_headers(spark, scratch):
    p = pages(spark)
    W.write(p, f"file://{scratch}/w")
    back = W.read(spark, f"file://{scratch}/w")
    assert back.count() == p.count()
    assert {r.page_id for r in back.where("record_type = 'revisit'").collect()} == {1, 3, None, 11}
    one = back.where("page_id = 13").collect()
    assert len(one) == 1 and bytes(one[0].payload) == b"long text " * 30_000
    revisits = back.where("record_type = 'revisit'").collect()
    assert revisits and all(r.payload is None and r.refers_to is not None for r in revisits)
    reader = W.WarcReader(back.schema, {"path": f"file://{scratch}/w"})
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("page_id",), 3)]))
    assert len(left) == 1 and len(reader.wanted) == 1


def test_small_ranges_cover_each_record_once(spark, scratch, monkeypatch):
    p = pages(spark).coalesce(1)
    recs = W.records(p).coalesce(1)
    W.register(spark)
    from pyspark.sql.types import StructType
    writer = W.WarcWriter({"path": f"{scratch}/r"})
    monkeypatch.setattr(W, "RANGE_BYTES", 300)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in recs.collect()],
                                       pa.schema([*W.TYPES.items(), ("target_uri", pa.string()), ("refers_to_uri", pa.string())]))

    class Context:
        def partitionId(self):
            return 0

        def taskAttemptId(self):
            return 7

    import pyspark
    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: Context()))
    first, second = writer.write(iter([batch])), None
    Context.taskAttemptId = lambda self: 8
    second = writer.write(iter([batch]))
    writer.commit([second])  # the first attempt's file goes
    reader = W.WarcReader(StructType([f for f in recs.schema if f.name in W.TYPES]), {"path": f"{scratch}/r"})
    parts = reader.partitions()
    assert len(parts) > 3 and first.temporary != second.temporary
    rows = [row for part in parts for b in reader.read(part) for row in b.to_pylist()]
    key = lambda r: repr(sorted(r.items(), key=lambda kv: kv[0]))
    want = [{k: r[k] for k in W.TYPES} for r in batch.to_pylist()]
    assert sorted(map(key, [{**r, "payload": r["payload"] or None} for r in rows])) == sorted(map(key, [{**r, "payload": r["payload"] or None} for r in want]))


def by_hand(kind, fields, block=b""):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:0>", "WARC-Date: 2020-01-01T00:00:00Z",
             *fields, f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_others(spark, scratch):
    """A member a record, without lengths in the members or a list of ranges; several records in one member."""
    body = b"<html>" + b"\r\n\r\n" * 9 + bytes(range(256)) * 700
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    made = [by_hand("warcinfo", ["Content-Type: application/warc-fields"], b"software: hand\r\n"),
            by_hand("response", ["content-type:application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"],
                    b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n" + body),
            by_hand("resource", ["WARC-Payload-Digest: md5:00", "X-Page-ID: 12"], b"plain"),
            by_hand("revisit", ["WARC-Payload-Digest: sha1:" + digest]),
            by_hand("metadata", [])]
    os.makedirs(f"{scratch}/o")
    with open(f"{scratch}/o/each.warc.gz", "wb") as f:
        f.write(b"".join(map(gzip.compress, made)))
    with open(f"{scratch}/o/one.warc.gz", "wb") as f:
        f.write(gzip.compress(b"".join(made)))
    sha1 = hashlib.sha1(body).hexdigest()
    want = [(None, "metadata", None, 0, None, b""), (None, "response", sha1, len(body), None, body),
            (12, "resource", "md5:00", 5, None, b"plain"), (None, "revisit", sha1, 0, None, None),
            (None, "warcinfo", None, 16, None, b"software: hand\r\n")]
    back = W.read(spark, f"file://{scratch}/o")
    got = [(*r[:5], None if r.payload is None else bytes(r.payload)) for r in back.collect()]
    assert sorted(got, key=repr) == sorted(want * 2, key=repr)
    assert back.where("record_type = 'resource'").select("payload_bytes").collect() == [(5,), (5,)]


def test_written_records_are_standard(spark, scratch):
    W.write(pages(spark), f"file://{scratch}/s", date="2021-02-03T04:05:06Z")
    ids, kinds = [], collections.Counter()
    for name in os.listdir(f"{scratch}/s"):
        if not name.endswith(".warc.gz"):
            continue
        data = open(f"{scratch}/s/{name}", "rb").read()
        while data:  # any gzip reader: each member is a whole record
            z = zlib.decompressobj(31)
            text = z.decompress(data)
            assert W.member_length(data[:64]) == len(data) - len(z.unused_data)
            data = z.unused_data
            head, _, rest = text.partition(b"\r\n\r\n")
            h = W.parse_headers(head)
            assert len(rest) == int(h["content-length"]) + 4 and rest.endswith(b"\r\n\r\n")
            assert h["warc-date"] == "2021-02-03T04:05:06Z" and h["warc-target-uri"] == "u"
            ids.append(h["warc-record-id"])
            kinds[h["warc-type"]] += 1
            if h["warc-type"] == "revisit":
                assert h["warc-refers-to-target-uri"] == "u" and h["warc-refers-to-date"] == h["warc-date"]
    assert len(set(ids)) == len(ids) == 15 and kinds["revisit"] == 5


def test_rejected_payloads_are_not_inflated(spark, scratch):
    rows = [{"page_id": i, "record_type": "response", "payload_digest": "00" * 20, "payload_bytes": 300_000,
             "refers_to": None, "payload": os.urandom(300_000), "target_uri": None} for i in range(5)]
    data = b"".join(W.member(W.record(r, f"id-{r['page_id']}", W.DATE)) for r in rows)
    seen = []

    class Spy(W.Inflated):
        def take(self, n):
            seen.append(n)
            return super().take(n)

    stream = Spy(io.BytesIO(data), 0, len(data))
    for _ in rows:
        assert stream.starts()
        h = W.parse_headers(stream.take(stream.head()))
        stream.skip(int(h["content-length"]) + 4)
    assert not stream.starts() and sum(seen) < 5000


def test_header_block():
    row = {"page_id": 5, "record_type": "revisit", "payload_digest": "00" * 20, "payload_bytes": 12, "refers_to": 9,
           "payload": None, "target_uri": "http://a/\r\nX-Page-ID: 7", "refers_to_uri": None}
    h = W.parse_headers(W.record(row, "x", W.DATE).split(b"\r\n\r\n")[0])
    assert h["warc-type"] == "revisit" and W.number(h["x-refers-to-page"]) == 9 and h["x-page-id"] == "5"
    assert "warc-refers-to-target-uri" not in h and W.number(None) is None
