import base64
import gzip
import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventmart.llm import warc
from eventmart.session import Workspace


def split(data):
    found = list(warc.salvage(data))
    return [f for f in found if isinstance(f, warc.Record)], [f for f in found if isinstance(f, warc.Gap)]


def payloads(n=12):
    rng = random.Random(4)
    texts = [b"", b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", b"\x1f\x8b\x08 no member", b"\0" * 50]
    return texts + [bytes(rng.choices(range(256), k=rng.randrange(400))) for _ in range(n - len(texts))]


def archive(packed):
    parts = [warc.record(i, f"http://x/{i}", p) for i, p in enumerate(payloads())]
    parts = [warc.member(p) + b"\0" if packed else p for p in parts]
    ends = [sum(map(len, parts[: i + 1])) for i in range(len(parts))]
    return b"".join(parts), [(e - len(p), e) for p, e in zip(parts, ends)]


@pytest.mark.parametrize("packed", [True, False])
def test_undamaged(packed):
    data, _ = archive(packed)
    records, gaps = split(data)
    assert [r.payload for r in records] == payloads() and gaps == []
    if packed:  # other readers skip the padding
        assert gzip.decompress(data) == archive(False)[0]


@pytest.mark.parametrize("packed", [True, False])
@settings(max_examples=120, deadline=None)
@given(damage=st.data())
def test_records_outside_the_damage_are_recovered(packed, damage):
    """Whatever bytes change, go or come in between: all other records are read, nothing else."""
    data, places = archive(packed)
    start = damage.draw(st.integers(0, len(data) - 1))
    end = min(len(data), start + damage.draw(st.integers(0, 300)))
    junk = damage.draw(st.binary(max_size=40))
    broken = data[:start] + junk + data[end:]
    records, gaps = split(broken)
    found = [r.payload for r in records]
    safe = [p for p, (s, e) in zip(payloads(), places) if e <= start or s >= end]
    rest = iter(found)
    assert all(any(f == p for f in rest) for p in safe)  # in order
    # a record inside a payload, which has no digests, may come to light when its own breaks
    assert all(f in payloads() or b"abc" in f for f in found)
    for gap in gaps:
        assert gap.start < gap.end <= len(broken) and gap.reason
    spans = sorted([(r.start, r.end) for r in records] + [(g.start, g.end) for g in gaps])
    assert all(a[1] <= b[0] or a == b for a, b in zip(spans, spans[1:]))


def test_a_revisit_keeps_the_size_of_what_it_refers_to():
    (record,), gaps = split(warc.record(7, None, b"x" * 99, refers=3))
    assert record.payload == b"" and record.payload_bytes == 99 and not gaps
    assert record.fields["warc-refers-to"] == "<urn:page:3>"


def many(n=9):
    """Records with digests, so that nothing comes to light inside a payload."""
    rng = random.Random(8)
    bodies = [bytes(rng.choices(range(256), k=300)) for _ in range(n)]
    return bodies, [warc.record(i, f"http://x/{i}", b) for i, b in enumerate(bodies)]


def test_a_bad_record_inside_a_member_costs_only_itself():
    bodies, parts = many()
    bad = parts[4][:-100] + b"??" + parts[4][-98:]
    whole = warc.member(b"".join([*parts[:4], bad, *parts[5:]]))
    records, gaps = split(whole + warc.member(parts[4]))
    assert [r.payload for r in records] == bodies[:4] + bodies[5:] + [bodies[4]]
    assert {(r.start, r.end) for r in records[:-1]} == {(0, len(whole))}
    place = sum(map(len, parts[:4]))
    assert [(g.start, g.end) for g in gaps] == [(0, len(whole))]
    assert f"bytes {place} to {place + len(bad)} of" in gaps[0].reason


@pytest.mark.parametrize("level", [0, 6])
@settings(max_examples=60, deadline=None)
@given(damage=st.data())
def test_a_broken_member_gives_the_records_before_the_error(level, damage):
    bodies, parts = many()
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    packed, places = b"", []
    for part in parts:  # a record is packed when its flush is
        packed += pack.compress(part) + pack.flush(zlib.Z_SYNC_FLUSH)
        places.append(len(packed))
    packed += pack.flush()
    cut = damage.draw(st.integers(3, len(packed) - 1))
    junk = damage.draw(st.sampled_from([b"", b"\xff" * 20]))
    data = packed[:cut] + junk + warc.member(parts[0])
    records, gaps = split(data)
    found = [r.payload for r in records]
    before = sum(p <= cut for p in places)
    assert found[:before] == bodies[:before] and found[-1] == bodies[0]
    assert len(found) <= before + 2 and len(gaps) >= 1
    spans = sorted({(r.start, r.end) for r in records} | {(g.start, g.end) for g in gaps})
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_a_cut_member_at_the_end():
    bodies, parts = many()
    packed = warc.member(b"".join(parts))
    records, gaps = split(packed[:-9])
    assert [r.payload for r in records][:8] == bodies[:8] and len(gaps) == 1


def test_digests_of_other_algorithms_and_encodings():
    def with_digest(digest, body=b"a body"):
        head = f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Block-Digest: {digest}\r\n"
        return head.encode() + b"Content-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)

    for algorithm in ("md5", "sha1", "sha256", "SHA-512"):
        right = hashlib.new(algorithm.lower().replace("-", ""), b"a body").digest()
        for write in (bytes.hex, base64.b32encode, base64.b64encode, base64.urlsafe_b64encode):
            text = write(right) if write is bytes.hex else write(right).decode()
            forms = {text, text.rstrip("=")}
            forms |= {text.upper(), text.lower()} if "64" not in write.__name__ else set()
            for form in forms:
                assert len(split(with_digest(f"{algorithm}:{form}"))[0]) == 1, form
                assert split(with_digest(f"{algorithm}:{form}", b"a Body"))[0] == []
    assert len(split(with_digest("blake9:0000"))[0]) == 1


def test_only_http_records_have_http_headers():
    body = b"first\r\n\r\nsecond"
    digest = "sha1:" + warc.base32_sha1(body)
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nContent-Type: text/plain\r\nWARC-Payload-Digest: {digest}\r\n"
    data = head.encode() + b"Content-Length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    (record,), gaps = split(data)
    assert record.payload == body and record.payload_bytes == len(body) and not gaps


PAGES = "page_id long, url string, html string"


def by_hand(rows):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = max(same, default=None)
        other = first is not None and page != first
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "revisit" if other else "response", first if other else None))
    return out


def test_round_trip(spark):
    rows = [(i, f"http://x/{i}\r\nEvil: 1", f"page {i % 7} é😀" * (i % 7)) for i in range(60)]
    rows += [(100, None, None), (101, "u", ""), (None, None, "only here"), (None, "u", "page 1 é😀")]
    rows += [(200, "u", "twice"), (200, "u", "twice"), (201, "long", "<p>\r\n\r\n" * 200_000)]
    out = [tuple(r) for r in warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()]
    assert sorted(out, key=str) == sorted(by_hand(rows), key=str)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).collect() == []


def test_archives_on_disk(spark, tmp_path):
    """Several archives, read back with payloads; a damaged file loses one record and says so."""
    rows = [(i, "u", f"text {i} " * 30, None) for i in range(50)]
    pages = spark.createDataFrame(rows, PAGES + ", refers_to long").coalesce(1)
    folder = str(tmp_path / "archives")
    warc.write_archives(pages, folder, archive_bytes=3000)
    files = sorted((tmp_path / "archives").rglob("part-*"))
    assert len(files) > 3
    for checksum in (tmp_path / "archives").rglob(".*.crc"):
        checksum.unlink()
    files[0].write_bytes(files[0].read_bytes()[:40] + b"??" + files[0].read_bytes()[42:])
    out = warc.read_archives(spark, folder).collect()
    assert len([r for r in out if r["gap"] is None]) == 49
    assert sum(r["gap"] is not None for r in out) == 1
    assert {bytes(r["payload"]) for r in out if r["gap"] is None} < {r[2].encode() for r in rows}


def test_extra_columns(spark):
    rows = [(1, "u", "a", "own", "own"), (2, "u", "a", "own", "own")]
    pages = spark.createDataFrame(rows, PAGES + ", digest string, refers_to string")
    out = sorted(tuple(r) for r in warc.round_trip(pages).select("page_id", "record_type").collect())
    assert out == [(1, "revisit"), (2, "response")]
    with Workspace(spark) as space:
        assert space.folder
