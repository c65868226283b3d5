import hashlib

import duckdb
import pytest

from gatewright.llm import url_filter as uf
from gatewright.llm import warc

PAGES = [
    (1, "http://a.org/x", '<LINK rel="canonical" HREF="http://b.net/es/q">'),
    (2, "http://b.net/es/q", None),
    (3, "http://c.org/", '<meta http-equiv="refresh" content="0; url=/y">'),
    (4, "http://c.org/y#z", "<link href=http://a.org/x rel=canonical>"),
    (5, "http://d.org/", '<link rel=canonical href="http://z.com/p"><link rel="icon" href="http://b.net/fr/">'),
    (6, "http://e.org/", '<link rel=canonical href="http://d.org/">'),
    (7, "https://E.org", "<link rel=canonical href='http://q.net/fr/'>"),
    (8, None, None), (9, "nohost", '<link rel=canonical href="x">'),
    (10, "http://e.org/?a=1&b=2", '<link rel=canonical href="?a=1&amp;b=3">'),
    (10, "http://e.org/?a=1&b=2", '<link rel=canonical href="?a=1&amp;b=3">'),
    (11, "http://e.org/?a=1&b=3", '<link rel=canonical href="//d.org/">'),
    (12, "https://Example.COM/en/", ""), (13, "http://www.example.com/en/x", ""), (14, "http://example.com", ""),
    (15, "http://xexample.com/en/", ""), (16, "http://m.net/es/#a", ""), (17, "http://net/es/?x", ""),
    (18, "http://f.net/fr", '<link rel=canonical href="fr/">'), (19, "x://www.example.com/en/q", ""),
    (20, "http://loser.org/", '<link rel=canonical href="http://example.com/en/1">'),
    (21, "http://www.example.com/en/2", '<link rel=canonical href="http://r.net/es/1">'),
    (22, "http://third.org/", '<link rel=canonical href="http://www.example.com/en/2">'),
]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*row, 1) for row in PAGES], "page_id long, url string, html string, rule int")


@pytest.fixture()
def rules(spark):
    return spark.createDataFrame([*uf.RULES], "action string, rule string")


def test_verdicts(pages, rules):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.judge(pages, rules).collect()}
    verdicts = {i: v[3] for i, v in got.items()}
    assert {i for i, v in verdicts.items() if v == "block"} == {1, 2, 3, 4, 7, 12, 16, 17, 18, 20}
    assert got[12] == ("example.com", "/en/", "example.com/en/", "block")
    assert got[13][2:] == ("www.example.com/en/", "allow") and got[14] == ("example.com", "", None, "allow")
    assert got[15][2] == "com/" and got[8] == ("", "", None, "allow") and got[9][:2] == ("", "")
    assert got[21][3] == "allow" and got[22][2:] == (None, "allow")  # the allow comes before its block
    assert uf.judge(pages, rules).count() == len(PAGES)


def test_verdicts_equal_sql(pages, rules, tmp_path):
    pages.write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages/*.parquet'")
    want = con.execute(uf.OP1_SQL).fetchall()
    assert sorted(map(tuple, uf.judge(pages, rules).collect()), key=repr) == sorted(want, key=repr)


def test_redirects_from_a_table_and_empty_tables(spark, pages, rules):
    edges = spark.createDataFrame([("http://example.com/", "http://q.net/es/"), (None, "http://x.y/"),
                                   ("http://xyz.info/1", "http://q.net/es/")], "src string, dst string")
    one = spark.createDataFrame([(1, "https://xyz.info/1#top", None)], "page_id long, url string, html string")
    assert uf.judge(one, rules, edges).first().verdict == "allow"  # example.com/ is allowed by com/
    assert uf.judge(one, rules, edges.where("src like '%xyz%'")).first().verdict == "block"
    assert uf.judge(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in uf.judge(pages, rules.where("false")).collect()} == {"allow"}


def test_loser_tree(rng):
    for _ in range(60):
        runs = [sorted(rng.choices(range(50), k=rng.randint(0, 20))) for _ in range(rng.randint(0, 9))]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(sum(runs, []))


HTML = ["x" * 999, "y" * 1000, "y" * 1000, "x" * 999, "z\r\n\r\n" * 300, "é" * 500, "é" * 500, "", None, "z\r\n\r\n" * 300]


@pytest.fixture()
def captures(spark):
    rows = [(i, f"http://h{i % 3}.org/p{i}?q", h, "r") for i, h in enumerate(HTML)]
    rows += [(20, None, "n\x00ul", "r"), (21, "bad url\r\nX: y", "a", "r"), (2, "http://h2.org/p2?q", "y" * 1000, "r")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, run string"), rows


def test_round_trip(captures, tmp_path):
    df, rows = captures
    got = warc.capture_index(df, str(tmp_path / "warc")).collect()
    assert [(r.urlkey, r.ts) for r in got] == sorted((r.urlkey, r.ts) for r in got) and len(got) == len(rows)
    holders = {}
    for i, _, html, _ in rows:
        data = (html or "").encode()
        if len(data) >= 1000:
            holders[data] = max(i, holders.get(data, i))
    want = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        holder = holders.get(data)
        revisit = holder is not None and holder != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                     holder if revisit else None))
    assert sorted(map(repr, (tuple(r)[2:7] for r in got))) == sorted(map(repr, want))
    # every entry points at its record, and responses hold the payload
    by_id = {r[0]: (r[2] or "").encode() for r in rows}
    for r in got:
        with open(tmp_path / "warc" / r.file, "rb") as file:
            file.seek(r["at"])
            assert file.readline() == b"WARC/1.1\r\n"
            file.seek(r["at"])
            _, headers, payload = next(warc.parse_archive(file))
        assert headers["WARC-Record-ID"] == f"<urn:page:{r.page_id}>"
        assert payload == (by_id[r.page_id] if r.record_type == "response" else b"")


def test_runs_are_sorted_and_merged_over_many_partitions(spark, captures, tmp_path):
    df, rows = captures
    warc.write_archives(df.repartition(4), str(tmp_path / "w"))
    runs = warc.capture_runs(spark, str(tmp_path / "w"), run_rows=2)
    by_run = {}
    for r in runs.collect():
        by_run.setdefault(r.run, []).append(r)
    assert len(by_run) > 4
    for run in by_run.values():
        keys = [(r.urlkey, r.ts) for r in sorted(run, key=lambda r: r.seq)]
        assert keys == sorted(keys) and len(keys) <= 2
    merged = [(r.urlkey, r.ts, r.page_id) for r in warc.merge_runs(runs).collect()]
    assert merged == sorted(merged) and len(merged) == len(rows)


def test_files_are_bounded_by_bytes(spark, tmp_path):
    """A file is full before the next begins; a payload of megabytes has its own."""
    rows = [(i, f"http://h.org/{i}", f"{i} " * (2_000_000 if i == 9 else 500)) for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = tmp_path / "bounded"
    warc.write_archives(pages.repartition(2), str(folder), file_bytes=10_000)
    files = [f.read_bytes() for f in folder.rglob("part-*")]
    counts = [data.count(b"WARC/1.1\r\n") for data in files]
    assert sum(counts) == 30 and max(counts) > 1
    assert all(len(data) <= 10_000 or n == 1 for data, n in zip(files, counts))
    found = warc.capture_runs(spark, str(folder)).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in found) == [(i, len(h)) for i, _, h in rows]


def test_ranges_grow_with_the_rows(spark, captures, tmp_path):
    df, rows = captures
    warc.write_archives(df.repartition(3), str(tmp_path / "w"))
    merged = warc.merge_runs(warc.capture_runs(spark, str(tmp_path / "w"), run_rows=4), range_rows=1)
    assert merged.rdd.getNumPartitions() >= len(rows)
    keys = [(r.urlkey, r.ts, r.page_id) for r in merged.collect()]
    assert keys == sorted(keys) and len(keys) == len(rows)


def test_no_pages(captures, tmp_path):
    assert warc.capture_index(captures[0].where("false"), str(tmp_path / "none")).count() == 0
