"""Language, toxicity, quality, licences, archives, mixing, tokens, the pipeline."""

import inspect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from brisa.llm import bpe, catalog, common, language_id, licenses, mixing, perfect_hash, quality, shingle_join, toxicity, warc
from tests.llm.conftest import ODD

DATA = "/root/testdata/sf0.01"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_tokens_are_those_of_the_library(spark, odd, tokenizer):
    extra = [(20, "a" * 3000 + " <|endoftext|> naïve　 \x1c\x85 1234567 don't  \n\n x", "en", "a")]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    docs = docs.union(odd.select("doc_id", "text")).union(spark.createDataFrame([e[:2] for e in extra], "doc_id long, text string"))
    want = Counter((r.doc_id, tuple(tokenizer.encode_ordinary(r.text or ""))) for r in docs.collect())
    done = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    got = Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in done.collect())
    assert got == want
    back = Counter((r.doc_id, bytes(r.data)) for r in bpe.decode(done, RANKS, public_tokenizers.PATTERN).collect())
    assert back == Counter((r.doc_id, (r.text or "").encode()) for r in docs.collect())


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        hi, lo = rng.integers(0, 2**63, n).astype("<u8"), rng.integers(0, 2**63, n).astype("<u8")
        index = perfect_hash.PerfectHash.from_bytes(perfect_hash.PerfectHash.build(hi, lo).to_bytes())
        assert sorted(index.lookup(hi, lo).tolist()) == list(range(n))


def test_targets():
    t = mixing.standard_targets({"b": 100, "a": 10, None: 1000, "c": 0})
    assert t["c"] == 0 and t["a"] == 30 and sum(t.values()) == pytest.approx(1110)
    assert t["b"] == pytest.approx(300) and t[None] == pytest.approx(780)
    assert mixing.standard_targets({}) == {}


def test_flow_prefers_few_repeats():
    capacity = {("a",): 10, ("a", "b"): 20, ("b",): 5}
    flow = mixing.route(capacity, {"a": 25, "b": 30})
    assert sum(flow.values()) == 55
    cost = sum(sum(max(0, f - k * capacity[p]) for k in range(1, 3)) for p, f in flow.items())
    assert cost == 20  # all 35 words once, 20 of them again
    assert mixing.route(capacity, {"a": 1000, "b": 0})[("a",)] == 30


def test_mix_meets_its_targets(spark):
    a = {r.doc_id: r for r in mixing.standard_mix(spark.read.parquet(f"{DATA}/documents.parquet")).collect()}
    b = {r.doc_id: r for r in mixing.standard_mix(spark.read.parquet(f"{DATA}/documents.parquet").repartition(7)).collect()}
    assert a == b
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    taken, target = Counter(), {}
    for r in a.values():
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) <= 0.01 * t + 20 for s, t in target.items())


def test_selection_of_many_rows_needs_no_whole_group(make, monkeypatch):
    monkeypatch.setattr(mixing, "SELECT_ROWS", 20)
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 9), "en", "ab"[i % 2] if i % 5 else None) for i in range(900)]
    done = mixing.standard_mix(make(rows)).collect()
    taken, target = Counter(), {}
    for r in done:
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
    assert all(abs(taken[s] - t) <= 8 for s, t in target.items())


def test_long_documents_leave_no_room_open(spark):
    rng = random.Random(5)
    rows = []
    for i in range(40):  # 40 sources, each with five documents of 100,000 words
        sizes = [rng.randrange(50, 901) for _ in range(4995)] + [100_000] * 5
        rows += [(len(rows) + j, [f"s{i:02}"], n) for j, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, members array<string>, size int")
    total = Counter()
    for _, (s,), n in rows:
        total[s] += n
    taken, left = Counter(), {}
    for r in mixing.mix(docs, "members", "size", lambda sizes: {s: n // 2 for s, n in sizes.items()}).collect():
        (s,) = r.members
        taken[s] += r.repeats * r.size
        if not r.repeats:
            left[s] = min(r.size, left.get(s, r.size))
    gaps = {s: n // 2 - taken[s] for s, n in total.items()}
    assert all(0 <= gap < left[s] for s, gap in gaps.items())
    assert max(gap / (total[s] // 2) for s, gap in gaps.items()) < 0.001


def test_mix_of_odd_rows(make, odd):
    done = mixing.standard_mix(odd).collect()
    assert len(done) == len(ODD) and all(r.taken <= 3 * r.size for r in done)
    assert mixing.standard_mix(make([])).collect() == []
    assert all(r.taken == 0 for r in mixing.standard_mix(make([(1, None, None, "a"), (2, "", None, None)])).collect())


def test_overlapping_sources(spark):
    rows = [(i, [["a"], ["a", "b"], ["b"], [], None][i % 5], 10) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, members array<string>, size int")
    done = mixing.mix(docs, "members", "size", lambda sizes: {"a": 300, "b": 100}).collect()
    by = defaultdict(int)
    for r in done:
        by[tuple(r.members or ())] += r.repeats * r.size
    assert sum(by.values()) == 400 and by[()] == 0


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    found = [r for r in language_id.identify(docs).collect()]
    held = [r for r in found if r.held_out]
    assert len(found) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_of_odd_rows(spark, make, odd):
    model = language_id.train(spark.read.parquet(f"{DATA}/documents.parquet"))
    long = make([(50, "der die und " * 200_000, None, None), (51, "1234 !?", None, None)])
    got = {r.doc_id: r for r in language_id.predict(odd.union(long), model).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[51].lang_pred == "und" and got[50].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language_id.identify(make([(1, "x y", None, None)])).collect()} == {"und"}
    assert language_id.identify(make([])).collect() == []


def test_no_gram_is_missed_and_false_hits_are_few():
    rng = np.random.default_rng(2)
    held = [rng.integers(0, 2**32, 5000).astype(np.uint32) for _ in range(70)]  # more languages than one mask holds
    f = language_id.Filters.build([f"l{i}" for i in range(70)], [1] * 70, held)
    hits = f.hits(held[66], np.array([0]))[0]
    assert hits[66] == 5000 and np.delete(hits, 66).max() < 250


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = [r for r in toxicity.rate(docs, labels).join(labels, "doc_id").collect() if r.held_out]
    caught = [r.predicted for r in rows if r.toxic == 1]
    false = [r.predicted for r in rows if r.toxic == 0]
    assert sum(caught) >= 0.75 * len(caught) and sum(false) <= 0.03 * len(false)


def test_kernel_tolerates_gaps_and_insertions():
    k = toxicity.Kernel(["idiot"])

    def value(unit):
        return float(k([unit])[2].sum())

    assert value("idiot") == pytest.approx(1)
    assert min(value("idxiot"), value("iidiot"), value("idiiot")) >= toxicity.LEAST > value("window")
    assert toxicity.unit_of(b"i.d-i*o.t!") == "idiot" == toxicity.unit_of(b"1d10t")
    reader = toxicity.Reader(k)
    (words,) = reader.learn_all([b"you i d i o t now"])
    assert reader.sentences(words)[0][0] == pytest.approx(1)


def test_toxicity_of_odd_rows(spark, make, odd):
    labels = spark.createDataFrame([(1, None), (2, 1), (99, 0), (None, 1)], "doc_id long, toxic int")
    assert len(toxicity.rate(odd, labels).collect()) == len(ODD)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.rate(odd, none).collect()} == {0}
    assert toxicity.rate(make([]), none).collect() == []


def test_verdict_does_not_depend_on_the_order(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    a = {r.doc_id: r.kept for r in quality.cascade(docs).collect()}
    b = {r.doc_id: r.kept for r in quality.cascade(docs, quality.STANDARD[::-1], sample_rows=3).collect()}
    assert a == b and 0 < sum(a.values()) < len(a)


def test_rules_are_ordered_by_what_is_left(spark, tmp_path):
    rules = [quality.Rule(c, None) for c in "abc"]
    # b rejects most, a only what b rejects too, c little but of the rest
    rejected = np.array([[1, 1, 0], [1, 1, 0], [0, 1, 0], [0, 0, 1], [0, 0, 0]], dtype=bool)
    order = quality.greedy_order(rules, rejected, np.ones((5, 3)))
    assert [r.name for r in order] == ["b", "c", "a"]
    dear = np.array([[1, 100, 1]] * 5, dtype=float)
    assert [r.name for r in quality.greedy_order(rules, rejected, dear)] == ["a", "c", "b"]
    assert [r.name for r in quality.greedy_order(rules, rejected[:0], dear[:0])] == ["a", "b", "c"]
    path = str(tmp_path / "docs")
    spark.range(4000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text").repartitionByRange(40, "doc_id").write.parquet(path)
    docs = spark.read.parquet(path)
    ids = [r.doc_id for r in quality.spread_rows(docs, 50).collect()]
    assert len(ids) == 50 and max(ids) - min(ids) > 2500
    assert quality.spread_rows(docs.groupBy("text").count(), 50).count() == 50
    assert quality.spread_rows(docs.withColumn("_metadata", docs.doc_id), 7).count() == 7


def test_quality_counts(make, odd):
    m = quality.Measures("a b c d e a b c d e\nx #\n x #\nx #\n\n".encode())
    assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == (16, 16, 3, 1, 10)
    got = quality.cascade(odd, counts=quality.COUNTS).collect()
    assert len(got) == len(ODD) and not any(r.kept for r in got if r.n_words < 10)
    assert quality.cascade(make([])).collect() == []


def test_licences(make, odd):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction. The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."
    rows = [
        (1, mit + "\nAll rights reserved.", "en", "a"), (2, "x\nLicensed under CC BY-NC 4.0.\ny", "en", "a"),
        (3, "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "en", "a"),
        (4, "Licensed work of mine.", "en", "a"), (5, "The Software is provided as is, without warranty of any kind, express or implied.", "en", "a"),
    ]
    got = {r.doc_id: r for r in licenses.scan(make(rows)).collect()}
    assert got[1].licenses == "MIT,Proprietary" and got[1].unmatched == "" and got[2].licenses == "CC-BY-NC-4.0"
    assert got[4].n_found == 0 and got[5].licenses == "" and got[5].unmatched == "AsIs"
    assert len(licenses.scan(odd).collect()) == len(ODD) and licenses.scan(make([])).collect() == []
    assert all(any(c in t for c in licenses.CLUES) for texts in licenses.SENTENCES.values() for t in texts)


def test_archive_round_trip(spark, tmp_path):
    rows = [
        (1, "http://a.example/", "<html lang='en'><head><title>T &amp; t</title><script>x</script></head><body><p>Hi <b>you</b></p><a class=q href=\"/b\">b</a><!-- no --></body></html>"),
        (2, None, None), (None, "http://c.example/é", "é <p>ü"), (1, "http://a.example/", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = warc.derivatives(pages)
    got = {(r.page_id, r.target_uri, r.record_type, r.source_payload_digest): r for r in made.collect()}
    assert len(got) == 8
    refers = {r.record_id: r for r in warc.responses(pages).collect()}
    assert all(r.refers_to in refers and r.source_headers == refers[r.refers_to].http_headers for r in got.values())
    texts = [r.block for r in got.values() if r.record_type == "conversion"]
    assert "T & t\nHi you\nb" in texts and "é\nü" in texts
    assert any("outlink: /b L a/@href" in r.block for r in got.values())
    warc.write_warc(made, str(tmp_path / "out"), "2024-01-01T00:00:00Z")
    back = warc.read_warc(spark, str(tmp_path / "out")).collect()
    assert all(r.complete for r in back)
    key = lambda r: (r.record_id, r.refers_to, r.target_uri, r.source_headers, r.block, r.block_digest)
    assert Counter(map(key, back)) == Counter(map(key, made.collect()))


def test_archives_are_read_by_length(spark, tmp_path):
    """Blocks that hold records, other versions and line ends, cut and headless records; compressed and plain."""
    import base64
    import gzip
    import hashlib

    def record(block, version="1.1", eol="\r\n", length=None, extra=()):
        head = [f"WARC/{version}", "WARC-Type: resource", *extra, f"content-LENGTH: {len(block) if length is None else length}"]
        return eol.join(head).encode() + (eol * 2).encode() + block + (eol * 2).encode()

    inner = record(b"inside") + b"x WARC/1.1\r\nWARC/1.0\r\n" + b"\xff\x00 WARC/"
    right = hashlib.sha1(inner).digest()

    want = [
        ("1.1", inner, True), ("1.0", b"old", True), ("0.18", b"\n\nlf\n", True), ("1.1", b"", True),
        ("1.1", inner, True), ("1.1", inner, False), ("1.1", b"abc", False), ("1.1", b"q" * 300_000, True),
    ]
    data = [
        record(inner), record(b"old", "1.0"), record(b"\n\nlf\n", "0.18", "\n"), record(b""),
        record(inner, extra=["WARC-Block-Digest: sha1:" + base64.b32encode(right).decode(), "software: reads WARC/1.1 and", "  more"]),
        record(inner, extra=["WARC-Block-Digest: sha256:00"]), record(b"abcdef", length=3), record(b"q" * 300_000),
    ]
    cut = record(b"never whole", length=500)
    for name, pack in (("a.warc.gz", gzip.compress), ("b.warc", bytes)):
        (tmp_path / name).write_bytes(pack(b"".join(data)))
    # every record a stream of its own, as archives are packed, and the last one cut
    (tmp_path / "c.warc.gz").write_bytes(b"".join(map(gzip.compress, [b"junk\r\n", data[1], data[3], cut])))
    (tmp_path / "d.warc").write_bytes(b"")
    rows = warc.read_warc(spark, str(tmp_path)).selectExpr("version", "CAST(block AS BINARY) block", "complete", "record_type").collect()
    got = Counter((r.version, bytes(r.block), r.complete) for r in rows)
    want += want + [want[1], want[3], ("1.1", b"never whole\r\n\r\n", False), (None, b"junk\r\n", False)]
    assert got == Counter(want)
    assert {r.record_type for r in rows} == {"resource", None}


PAGES = [
    ('<script>document.write("<style>x</style>"); var token=1;</script>seen', "seen"),
    ("<p>a 3 < 5 and 7 > 2</p>", "a 3 < 5 and 7 > 2"),
    ("caf&eacute; &#8217; &#x1F600; &#150; &NotEqualTilde; &nope; a&b &amp;lt; x&#160;y &#0;", "caf\u00e9 \u2019 \U0001f600 \u2013 \u2242\u0338 &nope; a&b &lt; x y \ufffd"),
    ("&#xD800;|&#1114112;|&#65279;|&;|&#;|&amp", "\ufffd|\ufffd|\ufeff|&;|&#;|&amp"),
    ("one<!-- <script> -->two<script>never closed <p>x", "onetwo"),
    ("a<STYLE type='x'>p{}</style >b<noscript>c</noscript><template>d</template>e<noscript>f", "abef"),
    ("I </3 you <b", "I </3 you <b"),
    ("<pre\nclass=x>a<br/>b</pre><preface>c<a\nhref='x'>d</a>", "a\nb\ncd"),
    (None, ""), ("", ""), ("<p>" + "word &lt; " * 60_000, ("word < " * 60_000).strip()),
]


def test_text_of_pages(spark, tmp_path):
    """Expected texts, and the same from the SQL."""
    import duckdb

    pages = spark.createDataFrame([(i, None, h) for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r.page_id: r.block for r in warc.derivatives(pages).where("record_type = 'conversion'").collect()}
    assert got == {i: text for i, (_, text) in enumerate(PAGES)}
    pages.write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    rows = con.execute(f"SELECT page_id, block FROM ({warc.derivatives_sql()}) WHERE record_type = 'conversion'").fetchall()
    assert dict(rows) == got
    assert warc.derivatives(pages.limit(0)).collect() == []


def test_pipeline_on_a_small_table(spark, tokenizer):
    import corpus_pipeline

    base = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, base)
        assert kept.schema == docs.schema
    text = {r.doc_id: r.text for r in docs.collect()}
    out = catalog.QUERIES["pipeline"](spark, base).collect()
    assert 0 < len(out) and max(Counter(r.doc_id for r in out).values()) <= 3
    assert all(r.n_tokens == len(tokenizer.encode_ordinary(text[r.doc_id])) for r in out)


def test_pipeline_decides_by_row(spark, make):
    import corpus_pipeline

    near = [" ".join(f"{w}{i}" for i in range(200)) for w in ("a", "b", "c")]
    rows = [
        (None, near[0], "en", "a"), (None, near[0] + " x", "en", "a"), (None, "alone and without any id at all", "en", "a"),
        (5, near[1], "en", "a"), (None, near[1] + " x", "en", "a"),
        (3, near[2], "en", "a"), (7, near[2] + " x", "en", "a"), (7, "another text under the id of a linked one", "en", "a"),
        (None, None, None, None), (None, "", None, None),
    ]
    kept = corpus_pipeline.near_copies(spark, make(rows), "").collect()
    assert Counter((r.doc_id, (r.text or "")[:2]) for r in kept) == Counter(
        {(None, "a0"): 1, (None, "al"): 1, (5, "b0"): 1, (3, "c0"): 1, (7, "an"): 1, (None, ""): 2}
    )

    rng = random.Random(3)
    rows = [(i % 3 or None, "w " * rng.randrange(1, 40) + str(i), "en", "ab"[i % 2]) for i in range(600)]
    docs = make(rows)
    out = Counter((r.source, r.text) for r in corpus_pipeline.mixed(spark, docs, "").collect())
    target = mixing.standard_targets({s: sum(len(t.split()) for _, t, _, x in rows if x == s) for s in "ab"})
    taken = {s: sum(n * len(t.split()) for (x, t), n in out.items() if x == s) for s in "ab"}
    assert max(out.values()) <= 3 and all(abs(taken[s] - target[s]) <= 40 for s in "ab")


def test_a_mix_brings_its_plan_without_python_workers(make):
    """The few rows of the plan are part of the query; as a list they started Python workers of another kind on every executor."""
    docs = make([(i, "w " * (i % 7 + 1), "en", "abc"[i % 3] if i % 4 else None) for i in range(60)])
    mixed = mixing.standard_mix(docs.select("doc_id", "text", "source"))
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    brought = [line for line in plan.splitlines() if "LogicalRDD" in line]
    assert not brought and "LocalRelation" in plan
    assert {r.source_size for r in mixed.collect()} == {r.n for r in docs.selectExpr(
        "source", "size(split(trim(text), ' ')) AS n").groupBy("source").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}


def test_small_tables_keep_nulls_and_types(spark):
    schema = common.T.StructType.fromDDL("a string, b int, c long, d double")
    rows = [("x", 1, 2**40, 0.1), (None, None, None, None), ("퟿", -1, 0, float("inf"))]
    made = common.small_table(spark, rows, schema)
    assert [tuple(r) for r in made.collect()] == rows and made.schema == schema
    assert common.small_table(spark, [], schema).collect() == []


def test_every_batch_of_the_pipeline_is_released(monkeypatch):
    calls = []

    class Pool:
        def release_unused(self):
            calls.append(1)

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    assert list(common.released(iter("abc"))) == ["a", "b", "c"] and len(calls) == 3
    for module in (bpe, toxicity, shingle_join):
        assert "in batches:" not in inspect.getsource(module)
