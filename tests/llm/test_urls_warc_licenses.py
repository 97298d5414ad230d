import gzip
import hashlib
import re
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from courtload.llm import licenses, url_rules, warc
from tests.llm.helpers import docs, prose

ALLOW, BLOCK = ("example.net/en/", "org/fr/", "both/"), ("net/", "example.com/de/", "both/", "a.b.c/x/y")
URLS = [None, "", "no scheme", "http://", "https://NET/", "http://net", "http://x.net/a?b", "http://a.example.net/en/x#y", "http://EXAMPLE.net/en",
        "http://notexample.com/de/", "http://example.com/de/", "http://example.com/DE/", "http://org/fr/", "http://x.org/fr", "ftp://É.net/é",
        "http://both/x", "http://q.a.b.c/x/yz", "http://a.b.c/x/", "http://net:80/", "x://http://net/", "http://a.net?x=/", "http://" + "a." * 500 + "net/" + "p" * 5000]


def brute_rule(url):
    host, path = url_rules.split_url(url)
    fits = [(len(r), len(h), r) for r in {*ALLOW, *BLOCK} for h, _, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    rule = max(fits)[2] if fits else None
    return host, path, rule, "block" if rule in BLOCK else "allow"


@pytest.mark.parametrize("way", ["array", "join"])
def test_rules_match_brute_force(spark, monkeypatch, way):
    if way == "join":
        monkeypatch.setattr(url_rules, "ARRAY_CHARS", 0)
    rows = [(k if k else None, u, "host", 1) for k, u in enumerate(URLS)] + [(3, URLS[3], "again", 2)]
    table = spark.createDataFrame(rows, "page_id long, url string, host string, rule int")
    got = url_rules.judge(table, ALLOW, BLOCK).collect()
    want = sorted(((k or 0, *brute_rule(u)) for k, u, *_ in rows), key=repr)
    assert sorted(((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in got), key=repr) == want
    assert url_rules.judge(table.limit(0), ALLOW, BLOCK).count() == 0


def test_no_rules(spark):
    table = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert [tuple(r) for r in url_rules.judge(table, (), ()).collect()] == [(1, "a", "/b", None, "allow")]


def test_collisions_are_told_apart(monkeypatch, tmp_path):
    monkeypatch.setattr(url_rules.xxhash, "xxh64_intdigest", lambda s: len(s) % 3)
    rules = {f"host{k}.net/p{k % 7}/": k % 2 == 0 for k in range(200)}
    url_rules.write_array(rules, str(tmp_path / "r.bin"))
    array = url_rules.DigestArray(str(tmp_path / "r.bin"))
    at = array.find([*rules, "absent.net/", "host1.net/p9/"])
    assert [bool(array.blocks[i]) for i in at[:200]] == list(rules.values()) and at[200:].tolist() == [-1, -1]


PAGES = [(3, "http://a/", "x" * 200), (2, "http://b/\r\nInjected: 1", "x" * 200), (2, "http://b/", "x" * 200), (9, None, "x" * 200),
         (None, "http://n/", "x" * 200), (4, "http://c/", "small"), (5, "http://d/", "small"), (6, "http://e/", None), (7, None, ""),
         (8, "http://f/", "é" * 50), (10, "http://g/", "é" * 50), (11, "http://h/", prose(1, 50_000)), (12, "http://i/", "<p>\r\n\r\n</p>" * 30),
         (13, "u", "y" * 99), (14, "u", "y" * 99)] + [(100 + k, f"http://z/{k}", prose(k, 60)) for k in range(40)]


def archive(spark, folder, roll, pages=PAGES, partitions=None):
    table = spark.createDataFrame([(*p, "resp") for p in pages], "page_id long, url string, html string, record_type string")
    table = table.repartition(partitions) if partitions else table
    warc.write(table, f"file://{folder}", roll=roll)
    return sorted(Path(folder).glob("*.warc.gz"))


def test_archive_round_trip(spark, tmp_path):
    from pyspark.sql.types import LongType
    files = archive(spark, tmp_path / "a", 2000)
    assert len(files) > 3 and not (tmp_path / "a" / "_temporary").exists()
    got = warc.read(spark, f"file://{tmp_path / 'a'}", LongType()).collect()
    assert len(got) == len(PAGES)
    firsts = {}
    for i, _, html in PAGES:
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            firsts[data] = min(firsts.get(data, i), i)
    digest = {hashlib.sha256(d).hexdigest(): d for d in [(h or "").encode() for _, _, h in PAGES]}
    assert sorted((r.page or 0, r.payload_digest) for r in got) == sorted((i or 0, hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in PAGES)
    responses = set()
    for r in got:
        data = digest[r.payload_digest]
        assert r.payload_bytes == len(data)
        if r.record_type == "response":
            assert r.payload == data and r.refers_to is None
            if len(data) >= 100:
                assert r.page == firsts[data] and data not in responses
                responses.add(data)
        else:
            assert r.refers_to == firsts[data] and r.payload is None and len(data) >= 100
    assert responses == set(firsts)
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert raw.count(b"WARC/1.1\r\n") == len(PAGES) + len(files) and b"\r\nInjected" not in raw


def test_archives_are_the_same_again(spark, tmp_path):
    a, b = (archive(spark, tmp_path / n, 3000) for n in "ab")
    assert [(f.name, f.read_bytes()) for f in a] == [(f.name, f.read_bytes()) for f in b]


def test_archives_do_not_depend_on_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 4000)
    pages = PAGES + [(2 ** 60 + k, f"http://big/{k}", prose(k, 80)) for k in range(60)] + [(77, "http://same/", "s" * 300)] * 40
    made, old = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for k, (split, shuffle) in enumerate(((1, 4), (4, 3), (16, 16))):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            rows = pages if k != 1 else pages[::-1]
            made.append([(f.name, f.read_bytes()) for f in archive(spark, tmp_path / f"p{k}", 3000, rows, split)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert made[0] == made[1] == made[2]
    assert len({name.split("-")[1] for name, _ in made[0]}) > 5      # shards


def test_shards_are_even_and_in_order(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", 100_000)
    keys = spark.range(20_000).select(F.col("id").alias("page"), F.sha2(F.col("id").cast("string"), 256).alias("digest"),
                                      F.lit(1).alias("n"), F.lit(100).alias("size"))
    found = warc.borders(keys)
    assert found == sorted(found) and len(found) == 19
    starts = [0, *(k[1] for k in found), 20_000]
    assert max(b - a for a, b in zip(starts, starts[1:])) < 3 * 1000
    assert warc.borders(keys.limit(0)) == []


def test_archive_of_nothing(spark, tmp_path):
    from pyspark.sql.types import LongType
    table = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(table, f"file://{tmp_path / 'n'}")
    assert warc.read(spark, f"file://{tmp_path / 'n'}", LongType()).count() == 0


def test_a_changed_payload_is_noticed(spark, tmp_path):
    data = warc.page_record(1, "u", b"payload", hashlib.sha256(b"other").hexdigest(), 0, None, False)
    headers, block = warc.parse(gzip.decompress(data))
    assert headers["WARC-Type"] == "response" and block.endswith(b"payload")
    with pytest.raises(ValueError):
        warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")


def test_every_template_is_found_as_itself(spark, tmp_path):
    texts = [(name, text) for name, many in licenses.TEMPLATES.items() for text in many]
    noise = " ".join(f"{w}%%%" for w in prose(2, 80).split())
    rows = [(k, f"{noise}\n{text}\n{noise}", "en") for k, (_, text) in enumerate(texts)]
    rows += [(900, None, None), (901, "", "en"), (None, "We got a license to drive. Copyright 2020.", "en"),
             (902, "Licensed under the Apache License, Version 1.1.", "en"), (903, "Licensed under CC BY-NC-ND 4.0.", "en"),
             (904, "Released under the MIT License.\n" * 3 + prose(1, 30_000), "en"), (905, prose(1, 30_000) + ". Licensed under the ISC License", "en"),
             (905, prose(1, 30_000) + ". Licensed under the ISC License", "en")]
    got = licenses.scan(docs(spark, tmp_path / "d", rows)).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r.license)
        text = next(t for i, t, _ in rows if i == r.doc_id)
        assert text[r.start:r.start + r.length] == r.wording
    for k, (name, _) in enumerate(texts):
        assert set(by_doc.pop(k)) == {name}
    assert by_doc == {904: ["MIT"] * 3, 905: ["ISC"] * 2}
    assert licenses.scan(docs(spark, tmp_path / "e", [])).count() == 0


def test_license_lines_of_the_documents_are_all_found(spark):
    lines = {"CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.", "MIT": "Released under the MIT License."}
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted((r.doc_id, n) for r in table.collect() for n, line in lines.items() for _ in range((r.text or "").count(line)))
    assert want and sorted((r.doc_id, r.license) for r in licenses.scan(table).collect()) == want


def found(text):
    return [(h["license"], h["wording"]) for h in licenses.default_templates().scan(text)]


@pytest.mark.parametrize("name", ["BSD-2-Clause", "BSD-3-Clause"])
@pytest.mark.parametrize("marks", [("1. ", "2. ", "3. "), ("  1) ", "  2) ", "  3) "), (" * (a) ", " * (b) ", " * (c) "), ("", "", "")])
def test_numbered_clauses_are_found(name, marks):
    text = licenses.TEMPLATES[name][1][:-1]
    for mark, clause in zip(marks, ("Redistributions of source", "Redistributions in binary", "Neither the name")):
        text = text.replace(clause, f"\n{mark}{clause}")
    assert found(text) == [(name, text)]


def test_a_number_after_the_wording_is_no_longer_version():
    for name, line in (("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0.")):
        for after in ("\n2021 Foo Inc.", " 2021 Foo Inc.", "\n\n1. Introduction", ""):
            assert found(line + after) == [(name, line[:-1])]
        assert found(line + "1 is another version") == found(line + "1") == []


def test_the_search_goes_on_after_a_refused_place():
    line = "Licensed under the Apache License, Version 2.0"
    assert found(f"{line}.1 was replaced.\n{line}.\n{line}.2.\n{line}.") == [("Apache-2.0", line)] * 2
    long = licenses.TEMPLATES["GPL-3.0"][2]
    other = long.replace("version 3", "version 9")
    assert found(f"{other}\n{long}\n{other}\n{long}") == [("GPL-3.0", long[:-1])] * 2


def test_affero_and_lesser_notices():
    notice = ("This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {} General Public License "
              "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version")
    for name, *of in (("AGPL-3.0", "program", "Affero"), ("LGPL-3.0", "program", "Lesser"), ("LGPL-3.0", "library", "Lesser")):
        assert found(notice.format(*of) + ".") == [(name, notice.format(*of))]


@pytest.mark.parametrize("columns", [40, 60, 70, 80])
@pytest.mark.parametrize("prefix", ["", "# ", "        * "])
def test_hard_wrapped_templates_are_found(columns, prefix):
    for name, many in licenses.TEMPLATES.items():
        for text in many:
            lines = textwrap.wrap(text, columns, break_long_words=False, break_on_hyphens=False)
            got = found(f"{prose(7, 300)}\n\n" + "\n".join(prefix + line for line in lines) + f"\n\n{prose(8, 300)}")
            assert [n for n, _ in got] == [name], (text, got)
            assert re.findall(r"\w+", got[0][1]) == re.findall(r"\w+", text)
