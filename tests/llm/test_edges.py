"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mlframe.llm import decontam, langid, lattice, mixing, pii, quality, simhash, substrings, tokens, warc
from tests.llm import brute

WORDS = "the of and ander honte tion erth lyand resti queau ment eau le la les der die und sch".split()


def text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "er", "ly"]) for _ in range(n))


CLASH = "rid string, fp int, size string, kept int, lines string, row string, copy int, position int, h int, cell int, found int"


def frame(spark, rows, lang="en"):
    out = spark.createDataFrame([(d, t, lang, s, None if t is None else len(t)) for d, t, s in rows],
                                "doc_id long, text string, lang string, source string, n_chars long")
    return out.withColumns({c.split()[0]: F.lit("7").cast(c.split()[1]) for c in CLASH.split(", ")})


LONG = text(1, 60)
ROWS = [(1, LONG, "a"), (2, LONG, "a"), (2, LONG, "a"), (3, None, "a"), (4, "", None), (5, " \n\t ", None), (6, text(2, 80) + " " + LONG, "b"),
        (None, LONG, "b"), (None, None, None), (7, "x" * 30_000, "b"), (8, text(3, 20_000), "c"), (9, "1" * 20_000 + " a." * 3_000 + "@", "c"),
        (10, "mail joe@x.org or 4111 1111 1111 1111, +1 (212) 555-0100; 10.0.0.1", "c"), (-5, "日本語 É ½ <|startoftext|> don't", "c")]
EMPTY = []


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS)


def pairs(rows):
    return [(d, t) for d, t, _ in rows]


def test_simhash(spark, docs):
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.query(docs).collect()), key=str)
    assert got == brute.near_duplicates(pairs(ROWS))
    assert simhash.query(frame(spark, EMPTY)).collect() == []
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})


def test_simhash_large_bucket(spark, monkeypatch):
    """A bucket of more fingerprints than a chunk links like any other."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    fps = [(1 << a) ^ (1 << b) for a in range(0, 20) for b in range(a)]
    fps += [0xF0F0F0F0F0F0 + 2**50, 0xF0F0F0F0F0F0 + 2**50 + 3, 0x0F0F0F0F0F0F0F0F]
    links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2).collect()
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        assert (r.a ^ r.b).bit_count() <= 2
        parent[root(r.a)] = root(r.b)
    for x in fps:
        for y in fps:
            if (x ^ y).bit_count() <= 2:
                assert root(x) == root(y)


def test_mixing(spark, docs):
    got = mixing.query(docs).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        assert r.taken <= 3 * r.size
    sizes = {}
    for d, t, s in ROWS:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    targets = {r.source_size: r.target for r in got}
    assert sum(sizes.values()) == pytest.approx(sum(targets[v] for v in sizes.values()))
    mix = mixing.curriculum(docs)
    assert mix.columns == docs.columns
    assert mix.count() == sum(r.taken // r.size for r in got if r.size) and by == {}
    assert mixing.query(frame(spark, EMPTY)).collect() == [] == mixing.curriculum(frame(spark, EMPTY)).collect()


def test_warc(spark, tmp_path):
    pages = [(1, "u", "same"), (5, "u\r\nX: y", "same"), (5, "v", "same"), (2, None, None), (3, "w", ""), (None, "n", "alone"), (7, "l", "é" * 200_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("sha", F.lit(1)).withColumn("keeper", F.lit(2))
    assert sorted((tuple(r) for r in warc.query(df).collect()), key=str) == brute.revisits([(p, h) for p, _, h in pages])
    assert warc.query(df.limit(0)).collect() == []


def test_warc_damage():
    records = [warc.record(i, "u", "response", None, b"payload %d " % i * 50) for i in range(40)]
    archive = warc.pack(records)
    assert list(warc.unpack(archive)) == records and [warc.parse(r)[0]["WARC-Record-ID"] for r in records][3] == "<urn:page:3>"
    for bad in (archive[:-3], archive[4:], b"\0" * 20, archive[:40]):
        with pytest.raises(Exception):
            [warc.parse(r) for r in warc.unpack(bad)]
    for change in ((b"WARC/1.1", b"WARC/9.9"), (b"payload 0", b"payload 9"), (b"Content-Length: 500", b"Content-Length: 499"), (b"WARC-Date", b"WARC-Day")):
        assert change[0] in records[0]
        with pytest.raises(ValueError):
            warc.parse(records[0].replace(*change))


def test_lattice(spark, docs):
    got, want = lattice.query(docs).collect(), brute.base_scores(pairs(ROWS))
    assert len(got) == len(ROWS)
    for r in got:
        if r.doc_id is not None:
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
            assert r.base_score == pytest.approx(want[r.doc_id][4])
        assert r.score < 0
    assert lattice.query(frame(spark, EMPTY)).collect() == []


def test_lattice_sums_all_segmentations():
    import math

    import numpy as np

    logp = np.log([0.1, 0.2, 0.05, 0.15, 0.3, 0.2])
    model = lattice.Lattice({"▁": 0, "a": 1, "b": 2, "ab": 3, "▁a": 4}, logp)
    want = 0.1 * 0.2 * 0.05 + 0.1 * 0.15 + 0.3 * 0.05
    assert math.exp(model.forward("▁ab")) == pytest.approx(want)
    uses = np.zeros(6)
    model.expect("▁ab", 2.0, uses)
    assert uses[3] == pytest.approx(2 * 0.1 * 0.15 / want) and uses[4] == pytest.approx(2 * 0.3 * 0.05 / want)


def test_langid(spark, docs):
    got = langid.query(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 5)} == {"und"}
    assert {r.lang_pred for r in langid.query(frame(spark, ROWS, None)).collect()} == {"und"}
    assert langid.query(frame(spark, EMPTY)).collect() == []


def test_langid_model_is_a_distribution():
    import numpy as np

    code, _, _ = langid.grams([b"the then there", b"that this"])
    keys, n = np.unique(code, return_counts=True)
    model = langid.Model.fit(["x"], np.zeros(len(keys), int), keys, n)
    ctx = keys[5] >> np.uint64(16)
    p = 2.0 ** model.bits((ctx << np.uint64(16)) | model.keys[0])
    assert p.sum() == pytest.approx(1 - 2.0 ** model.floor, abs=0.1)


def test_decontam(spark, docs):
    bench = spark.createDataFrame([(1, LONG), (2, None), (3, "short"), (4, LONG), (9, "")], "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = {(r.doc_id, r.item_id) for r in decontam.query(docs, bench).collect()}
    assert got == {(d, i) for d in (1, 2, 6, None) for i in (1, 4)}
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 5
    assert decontam.query(docs, bench.limit(0)).collect() == []
    assert decontam.query(frame(spark, EMPTY), bench).collect() == []


def test_quality(spark, docs):
    got = quality.query(docs).collect()
    assert len(got) == len(ROWS)
    text = dict(pairs(ROWS))
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(text[r.doc_id])
    assert quality.query(frame(spark, EMPTY)).collect() == []
    assert quality.keep_good(docs).columns == docs.columns


def test_quality_lines(spark):
    """A line of too many texts of a host goes; documents that keep too little go; copies of one text are one text."""
    common = text(9, 60)
    rows = [(i, common + f"\n{text(i, 20)}", "h") for i in range(60)] + [(100 + i, f"{common}\n{text(i, 200)}", "h") for i in range(5)]
    rows += [(200 + i, common, "other") for i in range(80)]
    got = {r.doc_id: r for r in quality.query(frame(spark, rows)).collect()}
    assert not any(got[i].kept for i in range(60)) and all(got[i].n_removed == 60 for i in range(60))
    assert all(got[100 + i].kept for i in range(5)) and all(got[200 + i].kept for i in range(80))


def test_tokens(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokens.query(docs).collect()), key=lambda r: r[1])
    want = brute.token_rows(pairs(ROWS), t)
    assert sorted(r[0::2] + r[3:] for r in got if r[0]) == sorted(r[0::2] + r[3:] for r in want if r[0])
    assert [r[0] for r in got] == [r[0] for r in want] and got[-1][1] + got[-1][2] == want[-1][1] + want[-1][2]
    assert tokens.query(frame(spark, EMPTY)).collect() == []


def test_elias_fano():
    import numpy as np

    for values in ([], [0], [5, 5, 5], sorted(random.Random(1).choices(range(10**9), k=3000)), list(range(2000)), [0] * 700 + [2**40]):
        coded = tokens.EliasFano.encode(np.array(values, np.int64))
        back, end = tokens.EliasFano.from_buffer(memoryview(coded.to_bytes()), 0)
        assert back.values().tolist() == values and end == len(coded.to_bytes())
        for i in range(0, len(values), 97):
            assert back.select(i) == values[i]
            for j in (i, min(i + 1, len(values)), min(i + 700, len(values)), len(values)):
                assert back.select_range(i, j).tolist() == values[i:j]
    far = tokens.Shard(memoryview(tokens.shard(0, [-2**63, 2**63 - 1], [1, 1], b"\1\0\1\0", 2)))
    assert far.places(0, 2)[0] == [-2**63, 2**63 - 1]
    data = tokens.shard(3, [None, 4, 4, 9], [1, 2, 0, 1], b"\1\0\2\0\3\0\7\0", 2)
    s = tokens.Shard(memoryview(data + b"\n"))
    assert [s.doc_id(i) for i in range(4)] == [None, 4, 4, 9] and [s.ids(i).tolist() for i in range(4)] == [[1], [2, 3], [], [7]]
    assert s.places(0, 4)[0] == [None, 4, 4, 9] and s.places(1, 3)[1].tolist() == [1, 3, 3]


def test_substrings(spark, docs):
    rows = [r for r in ROWS if r[0] is not None]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.query(docs).collect() if r.doc_id is not None), key=str)
    assert got == brute.repeats(pairs(rows))
    assert substrings.query(frame(spark, EMPTY)).collect() == []


def test_substrings_across_lots(spark, monkeypatch):
    parts = [text(100 + i, 40) for i in range(12)]
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(parts) if r.random() < 0.5 else text(1000 + 7 * i + j, 30) for j in range(4)), "s") for i in range(60)]
    got = substrings.query(frame(spark, rows).repartition(9)).collect()
    assert sorted(((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got), key=str) == brute.repeats(pairs(rows))


def test_personal(spark, docs):
    tricky = [(20, "a@b.c_d@e.f a@b@c.d x@-.- 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.255 +1 2 3-4 +12 345 678 9012.", "s"),
              (21, "4111-1111-1111-1111 4111111111111112 5500 0000 0000 0004-1 +49 (30) 1234567+1 234 567 8901", "s"),
              (22, "joe [at] example [dot] org, (212) 555-0100, phone 212 555 0100", "s"), (23, "é@é.com ü 😀 a.b+c@d-e.fg.hi, 😀 10.20.30.40", "s")]
    rows = ROWS + tricky
    text = dict(pairs(rows))
    got = pii.query(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute.personal(text[r.doc_id]) if r.doc_id is not None else brute.personal("")
        if r.doc_id is not None:
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want[:5], r
            assert set(want[5].split(",")) - {""} <= set(r.spans.split(","))
    assert pii.query(frame(spark, EMPTY)).collect() == []


def test_reliabilities_find_the_bad_labeler():
    r = random.Random(2)
    seen = {}
    for _ in range(4000):
        truth = r.random() < 0.4
        v = tuple((1 if truth else -1) * (1 if r.random() < p else -1) for p in (0.95, 0.9, 0.9, 0.5, 0.85))
        seen[v] = seen.get(v, 0) + 1
    _, table = pii.reliabilities([("card", v, n) for v, n in sorted(seen.items())])
    assert table[0, 2, 1] > 0.9 and abs(table[3, 2, 1] - table[3, 2, 0]) < 0.1


def test_stages(spark, docs):
    import os
    import tempfile

    folder = tempfile.mkdtemp(prefix="stages-")
    spark.createDataFrame([(1, text(50, 60))], "item_id long, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))
    for rows in (ROWS, EMPTY):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, frame(spark, rows), folder)
            out.count()
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
