"""WARC: round trips, chains against a plain walk, magic in payloads, odd inputs."""

import hashlib
import random

import pytest

from ledgerstar.llm import warc
from ledgerstar.llm.common import table
from ledgerstar.session import scratch_path


def brute(rows):
    """(page_id, bytes, digest, type, refers) of (page_id, payload) rows."""
    owner = {}
    for i, p in rows:
        b = (p or "").encode()
        if len(b) >= 1000 and i is not None:
            owner[b] = max(i, owner.get(b, i))
    out = []
    for i, p in rows:
        b = (p or "").encode()
        o = owner.get(b)
        again = o is not None and (i is None or i < o)
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", o if again else None))
    return sorted(out, key=str)


def have(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def fake(n, body="x" * 50):
    """A record as it may stand inside a payload."""
    return f"\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: {n}\r\n\r\n{body}\r\n\r\n"


def test_query_against_brute_force(spark, sf):
    from ledgerstar.llm.queries import op13_warc

    rows = [(r["page_id"], r["html"]) for r in table(spark, sf, "pages").collect()]
    assert have(op13_warc(spark, sf)) == brute(rows)


def test_equal_payloads_magic_and_odd_rows(spark):
    rng = random.Random(3)
    long = "größe " * 400
    rows = [(k, long) for k in range(40)] + [(100 + k, "short") for k in range(5)] + [(None, long), (None, None), (200, None), (201, ""), (202, "a\r\n\r\n"), (7, long)]
    rows += [(300, "see" + fake(50)), (301, "see" + fake(10**6)), (302, fake(50) * 9 + long), (303, "\r\n\r\nWARC/1.1\r\n" * 500), (304, fake(3) + fake(0, "") * 3),
             (305, "WARC/1.1\r\nContent-Length: 1\r\n\r\n"), (306, "ab" * 700_000), (307, "\r\n\r\nWARC/1.0\r\nContent-Length: -4\r\n\r\n")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, f"http://x/{i}\r\nWARC-Type: metadata" if i != 7 else None, p, "a", 1) for i, p in rows],
                               "page_id long, url string, html string, record string, n int").repartition(3)
    assert have(warc.round_trip(df)) == brute(rows)


def test_ranges_of_any_size_give_the_same_records(spark):
    rows = [(k, "p" * (k * 7 % 1500) + (fake(40) if k % 3 else fake(9000)) + str(k)) for k in range(60)]
    path = scratch_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([(i, "u", p) for i, p in rows], "page_id long, url string, html string").coalesce(2), path)
    want = sorted((str(i), len(p), hashlib.sha1(p.encode()).hexdigest()) for i, p in rows)
    for size in (61, 1000, 1 << 24):
        got = warc.read_archive(spark, path, range_bytes=size).collect()
        assert sorted((r["name"], r["payload_bytes"], r["payload_digest"]) for r in got) == want


def test_chains_against_a_walk(spark):
    rng = random.Random(1)
    links, want = [], set()
    for f in range(6):
        ends = sorted(rng.sample(range(1, 5000), 120))
        nodes = [0, *ends]
        nxt = {p: rng.choice([q for q in nodes[i + 1:i + 6]] or [9999]) for i, p in enumerate(nodes)}
        if f == 5:
            del nxt[0]  # a file that does not start with a record
        links += [(f, p, None if p % 37 == 5 else n) for p, n in nxt.items()]
        step = {a: b for g, a, b in links if g == f}
        at = 0
        while at in step:
            want.add((f, at))
            at = step[at]
    got = warc.reachable(spark.createDataFrame(links, "file long, pos long, next long"))
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_broken_files_are_errors(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "x" * 2000)], "page_id long, url string, html string")
    for name, change in (("cut", lambda b: b[:-3]), ("tail", lambda b: b + b"more"), ("payload", lambda b: b.replace(b"xxxx", b"xxyx", 1))):
        path = str(tmp_path / name)
        warc.write_archive(df.coalesce(1), path)
        (part,) = (tmp_path / name).glob("part-*")
        part.write_bytes(change(part.read_bytes()))
        for crc in (tmp_path / name).glob(".*.crc"):
            crc.unlink()
        with pytest.raises(Exception, match="chain of records|does not match"):
            warc.read_archive(spark, path).collect()


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(df).collect() == []
