import random
import zlib

import pytest

from sluice.llm import quality, toxicity
from tests.llm.conftest import words


@pytest.fixture(scope="module")
def labelled(spark):
    rng, docs, labels = random.Random(3), [], []
    for i in range(400):
        lines = [" ".join(words(rng, rng.randint(4, 12))) for _ in range(rng.randint(1, 12))]
        bad, toxic = i % 4 == 0, i % 5 == 0
        if bad:
            lines = [" ".join(w + "%%" for w in x.split()) for x in lines]
        if toxic:
            j = rng.randrange(len(lines))
            lines[j] += " " + " ".join(rng.choice(["grumbleworm", "snotwagon", "blatherskite"]) for _ in range(3))
        docs.append((i, "\n".join(lines), "en", "s", 1))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(1000, None, "en", "s", 1), (1001, "", "en", "s", 1), (1002, "x" * 20000, "en", "s", 1), (3, "twice", "en", "s", 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score long")
    return d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


@pytest.mark.parametrize(("run", "column", "folds", "held"), [(quality.quality, 1, 3, 1), (toxicity.toxicity, 2, 4, 2)])
def test_held_out_accuracy(labelled, run, column, folds, held):
    d, lab, rows = labelled
    got = run(d, lab).collect()
    assert len(got) == 404
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
    truth = {r[0]: r[column] for r in rows}
    out = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth and r.doc_id != 3]
    assert sum(out) / len(out) > 0.95


def test_held_out_labels_are_not_read(spark, labelled):
    """Turning held-out labels round changes no score."""
    d, lab, rows = labelled
    flip = spark.createDataFrame([(i, q if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - q, t if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - t) for i, q, t in rows], lab.schema)
    some = d.where("doc_id < 40")
    for run in (quality.quality, toxicity.toxicity):
        model = [sorted((r.doc_id, r.score) for r in run(d, x).where("doc_id < 40 and doc_id <> 3").collect()) for x in (lab, flip)]
        assert model[0] == model[1]
    assert some.count() == 41


def test_toxicity_does_not_depend_on_the_sample_s_mix(spark):
    rng, rows = random.Random(5), []
    for i in range(2700):
        toxic = i % 9 == 0
        holds = toxic or i % 20 == 1
        rows.append((i, " ".join([*words(rng, 20), *["snotwagon"] * holds]), int(toxic), holds))
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int, holds boolean")
    scores = []
    for most in (1500, 150):  # all 300 and 2400, or 150 and 300
        model = toxicity.train(d.select("doc_id", "text"), d.select("doc_id", "toxic"), toxicity.F.lit(True), most=most)
        p = model.score([r[1].encode() for r in rows if r[3]])
        scores.append(sum(p) / len(p))
    odds = [p / (1 - p) for p in scores]
    assert max(odds) / min(odds) < 2


def test_without_labels(spark, none, labelled):
    no = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for run in (quality.quality, toxicity.toxicity):
        assert {r.score for r in run(labelled[0].limit(5), no).collect()} == {0.5}
        assert run(none, labelled[1]).count() == 0


def test_savings_equal_plain_compression():
    """The batched, remembered savings against one compression a window, the long way."""
    import zstandard

    rng = random.Random(2)
    toxic = [" ".join([*words(rng, 9), "snotwagon", "blatherskite"]).encode() for _ in range(60)]
    ordinary = [" ".join(words(rng, 11)).encode() for _ in range(120)]
    model = toxicity.fitted(toxic, ordinary, 1 / 3)
    texts = [*toxic[:5], *ordinary[:5], b"", b"SnotWagon " * 30, b"x" * 200 + b" y"]

    def length(content, window):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=3, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False).compress(window))

    for text, got in zip(texts, model.savings(texts), strict=True):
        want = []
        for w in text.lower().split():
            parts = [w[i : i + 64] for i in range(0, max(1, len(w) - 32), 32)]
            want.append(max(length(model.contents[0], b" " + p + b" " + toxicity.TAIL) - length(model.contents[1], b" " + p + b" " + toxicity.TAIL) for p in parts))
        assert got.tolist() == want
    assert min(model.score([t + b" snotwagon" for t in ordinary])) > max(model.score(ordinary))


def test_contrasting_words_hold_what_sets_toxic_texts_apart():
    rng = random.Random(4)
    toxic = [" ".join([*words(rng, 9), f"snot{'aeiou'[i % 5]}wagon", "plain"]).encode() for i in range(100)]
    ordinary = [" ".join([*words(rng, 9), "plain"]).encode() for _ in range(200)]
    found = toxicity.contrasting(toxic, toxicity.distinctive_runs(toxic, ordinary))
    assert {w for w in found if b"wagon" in w} == {b" snot%cwagon " % c for c in b"aeiou"}
    assert sum(b"wagon" in w for w in found) == 100 and b" plain " not in found and len(found) < 130


def test_filter_of_columns_that_clash(spark, labelled):
    d, lab, rows = labelled
    df = d.withColumnsRenamed({"score": "_score", "lang": "__SCORE"})
    out = quality.good_documents(df, lab)
    good = {r.doc_id for r in quality.quality(d, lab).where("predicted = 1 and doc_id <> 3").collect()}
    assert out.columns == df.columns and {r.doc_id for r in out.where("doc_id <> 3").collect()} == good


def test_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(i % 3, f"text {i}") for i in range(90)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(3)] * 4, "doc_id long, quality int")
    got = quality.labelled_sample(docs, lab, "quality", quality.F.lit(True), 2).collect()
    assert len(got) == 2 == len({r.doc_id for r in got})


def test_features_do_not_depend_on_slabs(monkeypatch):
    import numpy as np

    texts = [b"one line", b"", b"a\nb!\n\n" + b"LONG line 123 | " * 40 + b"\nlast", "é ü".encode(), b"\n"]
    whole = quality.line_features(texts)
    monkeypatch.setattr(quality, "SLAB", 7)
    for a, b in zip(whole, quality.line_features(texts), strict=True):
        assert np.array_equal(a, b)


def test_long_texts_score_alike_by_pieces():
    import tracemalloc

    import numpy as np

    rng = random.Random(8)
    texts = ["\n".join(" ".join(words(rng, rng.randint(0, 9))) + rng.choice(["", "%% %%", "!"]) for _ in range(n)) for n in (1, 2, 30, 90) for _ in range(8)]
    texts = [t.encode() for t in [*texts, "same line\n" * 40, "\n" * 30, "", "x" * 900]]
    per = np.array([quality.line_features([t])[2][0] for t in texts])
    field = quality.fit(*quality.line_features(texts)[:2], per, np.array([t.count(b"%") < 3 for t in texts]).astype(int), steps=40)
    for most in (1, 50, 400):
        assert np.allclose(field.score(texts), field.score(texts, most), rtol=1e-9, atol=1e-12)
    p, _ = quality.marginals(u := np.array([rng.gauss(0, 2) for _ in range(50)]), field.transition, np.array([50]))
    for size in (1, 2, 7, 49, 50, 99):
        assert np.allclose(quality.long_marginals(u, field.transition, size), p)
    long = b"\n".join(b"word%d and some more of it" % i for i in range(400_000))  # 12 MB
    tracemalloc.start()
    field.score([long])
    assert tracemalloc.get_traced_memory()[1] < 12 * len(long)
    tracemalloc.stop()


def test_marginals_match_enumeration():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    per = np.array([3, 1, 4])
    unary, t = rng.normal(size=8), rng.normal(size=(2, 2))
    got, _ = quality.marginals(unary, t, per)
    at = 0
    for n in per:
        u = unary[at : at + n]
        weight, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=int(n)):
            s = sum(u[i] * (y[i] - 0.5) for i in range(n)) + sum(t[y[i - 1], y[i]] for i in range(1, n))
            weight += np.exp(s)
            good += np.exp(s) * np.array(y)
        assert np.allclose(got[at : at + n], good / weight)
        at += n
