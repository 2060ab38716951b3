"""Archives and URLs (op3, op10), and the registered queries with their oracles."""

import base64
import gzip
import hashlib
import io

import duckdb
import pytest

import check
from verbatide.llm import url_reputation as U
from verbatide.llm import warc as W
from verbatide.llm.queries import ORACLES, QUERIES, URL_RULES


def test_round_trip(spark, tmp_path):
    page = "<html>é</html>"
    rows = [(5, "http://a/\r\nX: y", page), (2, None, page), (9, "u", page), (7, "u", ""), (8, "v", None),
            (10, "w", "x" * 300000), (None, "w", page), (2, "dup", page), (11, "crlf", "a\r\n\r\nWARC/1.1\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    W.archive_pages(df, str(tmp_path / "a"))
    got = sorted(
        ((r.page_id or 0), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
        for r in W.archived_pages(spark, str(tmp_path / "a")).collect()
    )
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        first = min(j for j, _, h in rows if j is not None and (h or "") == (html or ""))
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        kind = ("response", None) if i == first else ("revisit", first)
        want.append((i or 0, len(raw), digest, *kind))
    assert got == sorted(want, key=lambda r: (r[0], r[1]))
    records = {r.record_id: r for r in W.read_archive(spark, str(tmp_path / "a")).collect()}
    assert bytes(records["<urn:page:11>"].payload) == b"a\r\n\r\nWARC/1.1\r\n"
    assert records["<urn:page:5>"].target_uri == "http://a/%0D%0AX: y"
    # Any gzip reader reads the files.
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "a").glob("*.gz"))
    assert whole.count(b"WARC-Type: ") == len(rows)


def test_short_payloads_are_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    W.archive_pages(df, str(tmp_path / "s"), least=3)
    assert {r.record_type for r in W.archived_pages(spark, str(tmp_path / "s")).collect()} == {"response"}
    W.archive_pages(df.limit(0), str(tmp_path / "e"))
    assert W.archived_pages(spark, str(tmp_path / "e")).collect() == []


class Counted(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out

    def size(self):
        return len(self.getvalue())


@pytest.mark.parametrize("form", ["plain", "member", "member without length"])
def test_unwanted_payloads_are_passed_by(form):
    rows = [
        {"record_type": "response", "record_id": f"<urn:page:{i}>", "payload": bytes(hashlib.sha512(b"%d" % i).digest() * 4000)}
        for i in range(6)
    ]
    raw = [W.record(r) for r in rows]
    make = {"plain": bytes, "member": W.gzip_member, "member without length": gzip.compress}[form]
    file = Counted(b"".join(map(make, raw)))
    wanted = lambda row: row["record_id"] == "<urn:page:4>"
    found = list(W.records(file, wanted, True))
    assert len(found) == 1 and found[0][-1] == rows[4]["payload"]
    if form == "plain":
        assert file.taken < 1.5 * len(raw[0])
    assert [r[-2:] for r in W.records(file, lambda row: True, False)] == [[256000, None]] * 6


def test_filters_reach_the_reader(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a"), (2, "v", "a")], "page_id long, url string, html string")
    W.archive_pages(df, str(tmp_path / "f"))
    wanted = W.read_archive(spark, str(tmp_path / "f")).filter("record_type = 'revisit' and target_uri like 'v%'")
    assert [r.record_id for r in wanted.collect()] == ["<urn:page:2>"]
    reader = W.WarcReader({"path": "x"})
    left = list(reader.pushFilters([W.EqualTo(("record_type",), "revisit"), W.EqualTo(("payload_length",), 1)]))
    assert len(left) == 1 and reader.wanted == [("EqualTo", "record_type", "revisit")]


def test_urls(spark):
    rows = [(1, "HTTP://A.Example.ORG/es/x?q#f"), (2, "http://example.org/en/12"), (3, "x://notexample.org"), (4, None),
            (5, "no host"), (6, "://h?x"), (7, "a://b://c/d"), (8, "http://É.com/de/"), (9, "http://m.com/fr/1"), (9, "http://m.com/fr/1"),
            (None, "http://bad.net/x"), (10, "http://new.bad.net/"), (11, "http://good.net/")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    seen = [("bad.net", 1)] * 60 + [("good.net", 0)] * 60 + [("one.net", 1), (None, 1), ("x.com", None), ("", 1)]
    outcomes = spark.createDataFrame(seen, "host string, bad int")
    judged = U.judge_urls(df, outcomes, URL_RULES)
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in judged.collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, "a.example.org", "/es/x", "example.org/es/", "block"),
            (2, "example.org", "/en/12", "example.org/en/1", "block"),
            (3, "notexample.org", "", None, "allow"),
            (4, "", "", None, "allow"),
            (5, "", "", None, "allow"),
            (6, "h", "", None, "allow"),
            (7, "b:", "//c/d", None, "allow"),
            (8, "É.com", "/de/", "com/de/", "block"),
            (9, "m.com", "/fr/1", "com/fr/", "allow"),
            (9, "m.com", "/fr/1", "com/fr/", "allow"),
            (None, "bad.net", "/x", None, "block"),
            (10, "new.bad.net", "/", None, "block"),
            (11, "good.net", "/", None, "allow"),
        ],
        key=str,
    )
    assert U.judge_urls(df, outcomes.limit(0), URL_RULES).count() == len(rows)
    assert U.judge_urls(df.limit(0), outcomes).collect() == []


def test_reputation_shrinks(spark):
    seen = [("a.x.net", 1)] * 3 + [("b.x.net", 1)] * 50 + [("c.x.net", 1)] * 50 + [("g.y.net", 0)] * 300 + [("n.z.net", 1)]
    rows = {r.host: r for r in U.reputations(spark.createDataFrame(seen, "host string, bad int"))["host"].collect()}
    # Few pages on a bad domain weigh more than as few on an unknown one.
    assert rows["a.x.net"]["mean"] > rows["n.z.net"]["mean"] > rows["g.y.net"]["mean"]
    assert rows["b.x.net"]["bound"] > rows["a.x.net"]["bound"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, small, name):
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"create view {table} as select * from '{small}/{table}.parquet'")
    _, outcome = check.check(spark, name, small, connection)
    assert outcome.startswith("ok"), outcome


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
