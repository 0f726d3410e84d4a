import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import ann, decontam, packing, sharding, urls, warc
from tests.llm.conftest import corpus, words

TOKENIZER = packing.public_tokenizer("word_bpe_49k.json")


# nearest neighbours
def test_recall_ties_and_invalid_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(800)]
    rows += [(i, [1.0] * 16) for i in range(800, 830)]  # equal vectors
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] + [1.0] * 15), (904, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"rank": F.lit(1), "score": F.lit(2)})
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0"), k=20, block=300).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows[:830]]
    ids, x = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        s = (x * x[ids == q]).sum(axis=1)
        best = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        hits += len({f[1] for f in found} & set(ids[best].tolist()))
        assert [f[0] for f in sorted(found)] == list(range(1, 21))
        assert all(abs(f[2] - s[ids == f[1]][0]) < 1e-12 for f in found)
        order = [(-f[2], f[1]) for f in sorted(found)]
        assert order == sorted(order)
    assert hits / (20 * len(got)) >= 0.9
    assert [f[1] for f in sorted(got[800])][:19] == list(range(801, 820))


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in ann.nearest(df, df.where("vec_id = 0")).collect()] == [(0, 1)]
    assert ann.nearest(df.limit(0), df).count() == 0


@pytest.mark.parametrize("norms", ["one of 1000", "lognormal", "ten rows"])
def test_recall_of_mixed_norms(spark, norms):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(10 if norms == "ten rows" else 1000, 64))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    if norms == "one of 1000":
        x[0] *= 1000
    else:
        x *= rng.lognormal(size=(len(x), 1))
    rows = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(10_000 + i, v) for i, v in enumerate(rng.normal(size=(60, 64)).tolist())], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest(rows, asked, k=20, seed=1).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    best = {r.vec_id: set(np.argsort(-(x @ np.array(r.embedding)))[:20].tolist()) for r in asked.collect()}
    assert {len(found.get(q, ())) for q in best} == {min(20, len(x))}
    assert sum(len(found[q] & b) for q, b in best.items()) >= (1 if norms == "ten rows" else 0.95) * sum(map(len, best.values()))


def test_repeated_rows(spark):
    """A repeated query row gets its own k rows each time; rows of one id and vector are one candidate."""
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(50, 8)).tolist())]
    rows += [rows[0], rows[0], rows[7], (7, rows[8][1]), (7, rows[9][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.where("vec_id = 0"), k=20).collect()
    q = np.array(rows[0][1])
    distinct = {(i, tuple(v)) for i, v in rows if i != 0}
    want = sorted(((float((np.array(v) * q).sum()), i) for i, v in distinct), key=lambda p: (-p[0], p[1]))[:20]
    assert len(got) == 60
    for rank in range(1, 21):
        at = [(r.vec_id, r.score) for r in got if r.rank == rank]
        assert len(at) == 3 and len(set(at)) == 1
        assert at[0][0] == want[rank - 1][1] and abs(at[0][1] - want[rank - 1][0]) < 1e-12


def test_hashing_visits_well_under_half():
    """Of unclustered vectors, for which hashing is hardest, and most of the nearest are among what is visited."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20_000, 64))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    q = rng.normal(size=(100, 64))
    cosine, share = ann.probe_share(20_000, 20, 64, ann.BITS, ann.TABLES)
    scheme = ann.Scheme(64, ann.TABLES, ann.BITS, 7, {0: ann.Range(1.0, ann.BITS, 0, cosine, round(share * 2**ann.BITS))}, x[:1000])
    seen = np.zeros((100, 20_000), bool)
    for t in range(ann.TABLES):
        keys = scheme.keys(x, 0, t)
        first, cost, step = scheme.probing(q, np.sqrt((q * q).sum(axis=1)), 0, t)
        for i in range(100):
            seen[i] |= np.isin(keys, ann.subsets(cost[i], step[i], int(first[i]), ann.threshold(cost[i], scheme.ranges[0].probes))[0])
    best = np.argsort(-(q @ x.T), axis=1)[:, :20]
    assert seen.mean() < 0.4
    assert np.take_along_axis(seen, best, axis=1).mean() >= 0.88


def test_probes_come_in_the_order_of_their_costs():
    rng = np.random.default_rng(4)
    for m in (1, 2, 7, 10):
        cost, step = rng.random(m), np.int64(1) << np.arange(m, dtype=np.int64)
        every = np.sort([sum(cost[j] for j in range(m) if c >> j & 1) for c in range(1 << m)])
        for probes in {1, min(3, 1 << m), 1 << (m - 1), 1 << m}:
            keys, sums = ann.subsets(cost, step, 0, ann.threshold(cost, probes))
            assert np.allclose(np.sort(sums), every[:probes]) and len(set(keys.tolist())) == probes


# decontamination of texts shorter than an item
def test_texts_shorter_than_the_item(spark):
    own = words(random.Random(11), 40)
    texts = [own[:39], own[:31], own[:30], own[5:], own[:4], words(random.Random(12), 39)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(own))], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.start, r.n_words, round(r.similarity, 9)) for r in decontam.leaks(docs, items).collect()}
    assert got == {i: (7, 0, n, round((n - 4) / 36, 9)) for i, n in ((0, 39), (1, 31), (3, 35))}
    assert {r.doc_id for r in decontam.without_leaks(docs, items).collect()} == {2, 4, 5}


# statistics of suffixes
def test_suffixes_of_all_labelled_urls(spark):
    pages = spark.createDataFrame([(i, f"http://h.s{i % 60}.{'net/es' if i % 2 else 'com'}/{i}") for i in range(600)] + [(600 + i, f"http://h.s{i}.org/{i}") for i in range(60)], "page_id long, url string")
    rules = [urls.rule("allow", "com/"), urls.rule("block", "net/es/")]
    labelled = urls.parsed(pages.where("page_id < 600")).withColumn("verdict", F.when(F.col("path").startswith("/es/"), "block").otherwise("allow"))
    _, suffixes, many = urls.trained(labelled, "page_id", most=40, trees=2, depth=2, seed=7)
    got = {r.suffix: r.suffix_blocked for r in suffixes.collect()}
    assert many
    assert got == {f"s{i}.{'net' if i % 2 else 'com'}": (11 if i % 2 else 1) / 12 for i in range(60)}
    judged = urls.judge(pages, rules, most=40).collect()
    assert sorted(r.page_id for r in judged) == list(range(660))


# sharding
@pytest.mark.parametrize("limit", [500, 4000, 10**9])
def test_shards_fit_and_only_full_ones_split(docs, limit):
    rows = sharding.shards(docs, limit).collect()
    assert len(rows) == docs.count()
    sums, size = {}, {}
    for r in rows:
        sums[r.prefix] = sums.get(r.prefix, 0) + r.n_bytes
        size[r.prefix] = (r.shard_bytes, r.oversized)
        assert len(r.prefix) == r.depth
    for p, b in sums.items():
        assert size[p] == (b, b > limit)
        assert b <= limit or len(p) == sharding.BITS
        if p:  # its parent was too large
            assert sum(v for q, v in sums.items() if q.startswith(p[:-1])) > limit
        assert not any(q != p and q.startswith(p) for q in sums)


def test_shards_of_one_hot_id_and_of_nothing(spark, none):
    hot = spark.createDataFrame([(7, f"text {i} " * 10) for i in range(200)], "doc_id long, text string")
    assert {r.oversized for r in sharding.shards(hot, 1000).collect()} == {False}
    same = spark.createDataFrame([(7, "same text")] * 50, "doc_id long, text string")
    assert {r.oversized for r in sharding.shards(same, 100).collect()} == {True}
    assert sharding.shards(none, 100).count() == 0


def test_written_shards(docs, tmp_path, spark):
    d = sharding.write_shards(docs.select("doc_id", "text"), 4000, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == d.count()


def test_written_shards_of_repeated_ids(spark, tmp_path):
    rows = [(i % 7, f"text {i % 13} " * 9, i, "x") for i in range(300)] + [(None, None, 300, "y"), (3, None, 301, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row int, shard string")
    d = sharding.write_shards(df, 2000, str(tmp_path / "r"))
    back = spark.read.parquet(str(tmp_path / "r"))
    assert sorted(r._row for r in back.collect()) == list(range(302))
    assert back.select("shard").distinct().count() == d.count()
    assert sum(r.shard_docs for r in d.collect()) == 302


def test_shards_of_a_few_long_texts(spark):
    rows = [(i, "x" * (100_000 if i < 3 else 10)) for i in range(500)]
    got = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), 1500).collect()
    assert len(got) == 500 and sum(r.oversized for r in got) == 3
    sums = {}
    for r in got:
        sums[r.prefix] = sums.get(r.prefix, 0) + r.n_bytes
    assert all(sums[r.prefix] == r.shard_bytes for r in got)


# packing
def test_pieces_cover_documents_without_gaps(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(TOKENIZER)
    rows = packing.pack(docs, TOKENIZER, sequence=256).collect()
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for i, x, *_ in corpus()}
    covered, sequences = {}, {}
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, x in ids.items():
        at = 0
        for start, n in sorted(covered[i]):
            assert start == at
            at += n
        assert at == len(x)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    assert sorted(sequences) == list(range(len(sequences)))


def test_ids_equal_the_tokenizers():
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_str(TOKENIZER), packing.Encoder(TOKENIZER, 50)
    texts = ["it's we'll don't5 3.14 x²½ ÀÉ ß ª\xa0b", "<|endoftext|> hi", "İstanbul ﬁ é ΑΣ", "", "  ", "a\x1cb", "x's! q''t --'re é've 9's ..'", "don''ll!'sab", *(c[1] for c in corpus() if c[1])]
    for x, raw in zip(texts, e(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids


def test_ids_equal_those_of_every_public_tokenizer():
    """Also of files whose rules differ a little from those that texts are split by."""
    import json

    from tokenizers import Tokenizer

    other = json.loads(packing.public_tokenizer("byte_bpe_50k.json"))
    known = json.loads(TOKENIZER)
    cased, marked = json.loads(TOKENIZER), json.loads(TOKENIZER)
    cased["normalizer"]["normalizers"] = cased["normalizer"]["normalizers"][:2]
    marked["added_tokens"][0]["content"] = "again"
    texts = ["It's  THREE 3.14 x²½\nÀÉ ß again and again", "", "  ", "<|endoftext|> hi", "Don''ll!'sab", *(c[1] for c in corpus()[:40] if c[1])]
    for told, fast in ((other, False), (known, True), (cased, False), (marked, False)):
        content = json.dumps(told)
        assert packing.splits_by_words(content) == fast
        t, e = Tokenizer.from_str(content), packing.Encoder(content, 50)
        for x, raw in zip(texts, e(texts), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids


def _naive(histogram, sequence):
    """Piece by piece: into the emptiest pack that takes it, else into a new one; how many packs are how full."""
    packs = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fit = min((f for f in packs if f + length <= sequence), default=None)
            if fit is None:
                packs.append(length)
            else:
                packs[packs.index(fit)] += length
    return sorted(packs)


def test_packs_equal_a_naive_packer_s():
    rng = random.Random(9)
    for _ in range(200):
        sequence = rng.choice([10, 16, 37])
        histogram = {rng.randint(1, sequence): rng.randint(1, 30) for _ in range(rng.randint(1, 8))}
        fill, ranks = {}, {}
        for length, rank, n, first, offset in packing.place(histogram, sequence):
            assert rank == ranks.get(length, 0)
            ranks[length] = rank + n
            for s in range(first, first + n):
                assert fill.get(s, 0) == offset
                fill[s] = offset + length
        assert ranks == histogram
        assert sorted(fill.values()) == _naive(histogram, sequence)


def test_packing_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a few words of text")] * 5 + [(1, "other")], "doc_id long, text string")
    rows = packing.pack(df, TOKENIZER, sequence=8).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows) >= 6
    assert sorted(r.doc_tokens for r in rows if r.start == 0) == [2] + [6] * 5 and sum(r.length for r in rows) == 32


def test_shortest_pack_first():
    slots = packing.place({10: 3, 6: 2, 4: 5}, 10)
    placed = sum(s[2] for s in slots)
    assert placed == 10
    fill = {}
    for length, _, n, first, offset in slots:
        for s in range(first, first + n):
            assert fill.get(s, 0) == offset
            fill[s] = offset + length
    assert max(fill.values()) <= 10 and len(fill) == 7


def test_packing_nothing(none):
    assert packing.pack(none, TOKENIZER).count() == 0


# url filter
RULES = [urls.rule("allow", "com/"), urls.rule("block", "example.com/en/"), urls.rule("allow", "www.example.com/en/"), urls.rule("block", "net/es/"), urls.rule("block", "net/fr/")]


def _judged(url):
    u = url or ""
    rest = u.split("://", 1)[1] if "://" in u else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])] if "://" in u else ""
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


def test_rules_and_trees(spark):
    rng = random.Random(1)
    hosts = ["example.com", "WWW.Example.COM", "blog.example.com", "a.net", "net", "x.org", "notexample.com", "É.com"]
    found = [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/en/x', '/EN/', '/es/1', '/fr/'])}{rng.choice(['', '?a=1&b=2', '#t'])}" for _ in range(300)]
    found += [None, "", "no scheme", "://", "http://", "a://b://c/d", "http://com?x/", "x" * 9000 + "://com/"]
    df = spark.createDataFrame(list(enumerate(found)), "page_id long, url string").withColumns({"host": F.lit(1), "suffix": F.lit(2), "html": F.lit("")})
    got = {r.page_id: r for r in urls.judge(df, RULES).collect()}
    assert len(got) == len(found)
    for i, u in enumerate(found):
        host, path, name, verdict = _judged(u)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_rendered_trees_equal_the_model_s(spark):
    """The SQL gives the class that the fitted model itself gives."""
    from pyspark.ml.feature import VectorAssembler

    rng = random.Random(6)
    rows = []
    for _ in range(500):
        x = [rng.random() * 10 for _ in urls.FEATURES]
        rows.append((*x, float(x[0] + x[3] * x[6] > 25 or x[10] < 2)))
    df = spark.createDataFrame(rows, [*urls.FEATURES, "label"])
    model = urls.fitted(df, trees=6, depth=4, seed=1)
    table = VectorAssembler(inputCols=list(urls.FEATURES), outputCol="features").transform(df)
    both = model.transform(table).withColumn("own", (F.expr(urls.score_sql(model)) > 0).cast("double"))
    assert both.where("own <> prediction").count() == 0 and 0 < both.agg(F.sum("own")).first()[0] < 500


def test_urls_without_labels(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [r.verdict for r in urls.judge(df, RULES).collect()] == ["allow"]
    assert urls.judge(df.limit(0), RULES).count() == 0


# decontamination
def test_leaks_match_brute_force(spark, docs, none):
    rng = random.Random(5)
    items = [words(rng, n) for n in (3, 5, 9, 20, 40, 59)]
    rows = []
    for i in range(60):
        body = words(rng, 80)
        if i % 2:
            it = list(items[i % 6])
            for _ in range(i % 3):
                it[rng.randrange(len(it))] = "other"
            body[30:30] = [w.upper() if i % 4 == 1 else w for w in it]
        rows.append((i, " ".join(body)))
    want = {}
    shingles = lambda w: [tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))]
    from collections import Counter

    for i, text in rows:
        w = text.lower().split()
        for k, it in enumerate(items):
            best = 0.0
            for p in range(len(w) - len(it) + 1):
                a, b = Counter(shingles(w[p : p + len(it)])), Counter(shingles(it))
                same = sum((a & b).values())
                best = max(best, same / (a.total() + b.total() - same))
            if best >= 0.75:
                want[i, k] = best
    bench = spark.createDataFrame([*((k, " ".join(it)) for k, it in enumerate(items)), (90, None), (91, ""), (None, "x y")], "item_id long, text string")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.leaks(df, bench).collect()}
    assert got == pytest.approx(want) and want
    small = {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench, block_bytes=100).collect()}
    assert small == set(want)
    assert {r.doc_id for r in decontam.without_leaks(df, bench).collect()} == {i for i, _ in rows} - {i for i, _ in want}
    assert decontam.leaks(none, bench).count() == 0 and decontam.leaks(df, bench.limit(0)).count() == 0
    assert decontam.leaks(docs, bench).count() >= 0


def test_multi_index_finds_all_within_the_radius_and_few_others():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 2, (40, decontam.BITS)).astype(np.uint8)
    index = decontam.Index(items)
    prints = items[rng.integers(0, 40, 300)]
    for i, p in enumerate(prints):
        p[rng.choice(decontam.BITS, i % (decontam.RADIUS + 1), replace=False)] ^= 1
    far = (prints[:, None, :] != items[None]).sum(axis=2)
    x, y = index.near(prints)
    assert set(zip(x.tolist(), y.tolist(), strict=True)) == set(zip(*(a.tolist() for a in np.nonzero(far <= decontam.RADIUS)), strict=True))
    x, _ = index.candidates(rng.integers(0, 2, (300, decontam.BITS)).astype(np.uint8))
    assert len(x) / (300 * 40) < 0.25  # of unlike pairs


def test_windows_that_repeat_a_word_are_found(spark):
    """A run of equal words replaced by another: 75 % in common by weight, though the vectors of counts differ much."""
    own = words(random.Random(3), 100)
    item, text = [*own, *["aa"] * 16], [*own, *["bb"] * 16]
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join([*text, "end"]))], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.start, r.similarity) for r in decontam.leaks(docs, bench).collect()}
    assert got == {i: (0, pytest.approx(96 / 128)) for i in (1, 2)}


def test_one_scan_for_many_blocks(spark):
    rows = [(i, " ".join(words(random.Random(i), 12))) for i in range(40)]
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(rows, "item_id long, text string")
    for scan_bytes, scans in ((1 << 20, 1), (1000, 3)):
        out = decontam.leaks(df, bench, block_bytes=200, scan_bytes=scan_bytes)
        assert {(r.doc_id, r.item_id) for r in out.collect()} == {(i, i) for i in range(40)}
        made = list(decontam._scans(bench, 5, 75, 200, scan_bytes))
        assert (len(made) == 1) == (scans == 1) and sum(len(b.ids) for m in made for b in m) == 40


# warc
def test_archives_round_trip(spark, tmp_path):
    big = "<p>payload</p>" * 20
    rows = [(5, "http://a/", big), (3, "http://b/\r\nX: y", big), (9, None, big), (1, "http://c/", "short"), (2, "http://c/", "short"), (4, "http://d/", None), (6, "http://e/", "é" * 60), (7, "http://f/", "x" * 300_000), (8, "http://g/", "a\r\n\r\nb" * 30), (None, "http://n/", big), (5, "http://a/", big)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(1), "archive": F.lit("z"), "refers_to": F.lit(0)})
    archives = warc.write_archives(df, archive_bytes=100_000)
    got = sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(archives).collect())
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        again = html == big and i != 3
        want.append((i or -1, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(want)
    (tmp_path / "w").mkdir()
    files = warc.export(archives, str(tmp_path / "w")).collect()
    assert sum(f.records for f in files) == len(rows)
    import struct

    import zstandard

    raw = open(files[0].file, "rb").read()
    magic, n = struct.unpack_from("<II", raw)
    assert magic == 0x184D2A5D
    reader = zstandard.ZstdDecompressor(dict_data=warc._loaded(raw[8 : 8 + n])).stream_reader(raw[8 + n :], read_across_frames=True)
    assert reader.read().count(b"WARC/1.1\r\n") == files[0].records


def test_dictionary_s_sample_is_a_rule():
    records = [b"%d " % i * 40 for i in range(400)]
    some = warc.dictionary(records, 4000, 50)
    assert some == warc.dictionary(records[::-1], 4000, 50) != warc.dictionary(records, 8000, 50)
    frames = list(warc.archive_frames(records, 4000, 50))
    assert list(warc.read_frames(frames)) == records


def test_a_page_of_many_copies(spark):
    """More copies than one row in HOT: joined by broadcast."""
    rows = [(i, "http://a/", "same " * 30 if i % 2 else f"own {i} " * 20) for i in range(2000)]
    got = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), archive_bytes=20_000)).collect()
    assert len(got) == 2000
    assert {(r.record_type, r.refers_to) for r in got if r.page_id % 2} == {("response", None), ("revisit", 1)}
    assert [r.page_id for r in got if r.page_id % 2 and r.record_type == "response"] == [1]
    assert {r.record_type for r in got if not r.page_id % 2} == {"response"}


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(df)).count() == 0
