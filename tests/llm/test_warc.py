import base64
import gzip
import hashlib
import io
import random

import pytest

from ferry.llm import warc as W

PAGES = "page_id long, url string, html string"


class Out(io.BytesIO):
    pass


def normalised(data, level=6):
    out, index = Out(), Out()
    n = W.normalise(io.BytesIO(data), out, index, level)
    return n, out.getvalue(), index.getvalue()


def records(rng, n):
    return [W.record(i, f"http://x/{i} \r\nevil: 1", bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 50, 5000]))), None)
            for i in range(n)]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 18])
def test_normalise_keeps_bytes_and_makes_members(monkeypatch, chunk):
    monkeypatch.setattr(W, "CHUNK", chunk)
    recs = records(random.Random(chunk), 12)
    n, out, index = normalised(gzip.compress(b"".join(recs)))
    assert n == 12 and gzip.decompress(out) == b"".join(recs)
    places = list(W.read_index(io.BytesIO(index)))
    assert len(places) == 12 and sum(length for _, length in places) == len(out)
    for rec, (offset, length) in zip(recs, places):
        assert gzip.decompress(out[offset:offset + length]) == rec
    # already one member per record, padded with zero bytes: the same again
    assert normalised(out + b"\0" * 9)[1] == out


def test_empty_and_broken_files():
    assert normalised(b"") == (0, b"", b"")
    assert normalised(gzip.compress(b""))[0] == 0
    whole = gzip.compress(b"".join(records(random.Random(1), 3)))
    with pytest.raises(ValueError):
        normalised(whole[:-20])
    rec = records(random.Random(1), 1)[0]
    for bad in (rec[:-4] + b"XXXX", rec[:40], b"GET / HTTP\r\n\r\n", rec[:-10]):
        with pytest.raises(ValueError):
            normalised(gzip.compress(bad))


def plain(rows, min_bytes=0):
    first = {}
    for page_id, _, html in rows:
        p = (html or "").encode()
        if len(p) >= min_bytes and page_id is not None:
            first[p] = min(first.get(p, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        p = (html or "").encode()
        f = first.get(p) if len(p) >= min_bytes else None
        revisit = f is not None and f != page_id
        out.append((page_id, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response",
                    f if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, min_bytes):
    rng = random.Random(2)
    bodies = ["", "a", "<p>é日本😀</p>", "\r\n\r\nWARC/1.1\r\n\r\n", "x" * 500_000, "line\n" * 50, None]
    rows = [(i, rng.choice([None, "http://a/b c", "http://é/", ""]), rng.choice(bodies)) for i in range(60)]
    rows += [rows[3]] * 3 + [(None, None, "only null"), (None, None, "only null"), (None, "u", "a"), (-4, "u", "neg")]
    df = spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", refers_to string").repartition(4)
    got = sorted((tuple(r) for r in W.archive_round_trip(df, min_bytes).collect()), key=str)
    assert got == plain(rows, min_bytes)


def test_empty_table(spark):
    assert W.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_a_changed_payload_is_noticed():
    rec = W.record(1, None, b"payload", None)
    with pytest.raises(ValueError):
        W.describe(*W.read_member(io.BytesIO(gzip.compress(rec.replace(b"\r\n\r\npayload", b"\r\n\r\npayloae"))), 0, 10**6))
