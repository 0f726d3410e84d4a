import hashlib

import pytest

from sluice.llm.neardup import near_duplicates
from sluice.llm import substr
from sluice.llm import words as words_of
from sluice.llm.substr import passage_digests, without_repeats
from tests.llm.conftest import SCHEMA, corpus

SPACE = bytes([0x20, *range(9, 14)])


def _set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _components(rows):
    sets = {r[0]: _set(r[1]) for r in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_near_duplicates_match_brute_force(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    assert got == _components(corpus())


def test_near_duplicates_blob_of_unlike_members(spark):
    """Many members of one bucket with few links: what the large-bucket path is for."""
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(90):
        t = list(base)
        for j in range(i % 9):
            t[(i * 37 + j * 17) % 150] = f"z{i}_{j}"
        rows.append((i, " ".join(t)))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _components(rows)


def test_near_duplicates_edges(spark, none):
    assert near_duplicates(none).count() == 0
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "q r s t u v")], "doc_id long, text string")
    rows = near_duplicates(twice).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (1, 1), (1, 1), (2, 1)]


def test_near_duplicates_of_an_id_with_several_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, "other words that stand alone here")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 1), (4, 4)} and len(got) == 5


def test_component_of_most_nodes(spark):
    """Its label goes to its nodes by broadcast."""
    from sluice.llm.graph import components

    links = [(i, i + 1) for i in range(700)] + [(2000 + 2 * i, 2001 + 2 * i) for i in range(100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(701)} | {i: i - i % 2 for i in range(2000, 2200)}


def _removed(rows):
    seen, out = set(), {}
    for i, t in sorted((r[0], r[1]) for r in rows):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - 19):
            key = tuple(w[j : j + 20])
            if key in seen:
                gone[j : j + 20] = [True] * 20
            seen.add(key)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_passages_match_brute_force(docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in passage_digests(docs).collect()}
    want = _removed(corpus())
    assert got == want
    assert any(n for _, n, _ in want.values())


@pytest.mark.parametrize("text", ["a " * 25, " ".join(f"w{i % 21}" for i in range(100)), "x y " * 30])
def test_repeats_inside_one_document(spark, text):
    got = passage_digests(spark.createDataFrame([(5, text)], "doc_id long, text string")).first()
    assert (got.n_words, got.n_removed, got.kept_sha256) == _removed([(5, text)])[5]


def test_passages_edges(spark, none):
    assert passage_digests(none).count() == 0
    rows = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))] * 2 + [(2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in passage_digests(rows).collect()) == [(1, 0), (1, 0), (2, 0)]


def test_texts_without_repeats(spark):
    p = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(1, f"a\n{p}", "en", "s", 1), (2, f"b {p} c", "en", "s", 1), (3, " kept  as is ", "en", "s", 1)], SCHEMA)
    got = {r.doc_id: r.text for r in without_repeats(df).collect()}
    assert got == {1: f"a\n{p}", 2: "b c", 3: " kept  as is "}


def test_paths_end_where_the_graph_branches(spark):
    """Two texts go through nodes 1-2-3-4 together; one enters at 2 from 9, one leaves from 3 to 8."""
    rows = [(1, 2, 0, 10, 0, 3), (2, 3, 0, 10, 1, 3), (3, 4, 0, 10, 2, 3), (4, 5, 0, 10, 3, 3), (9, 2, 0, 20, 0, 2), (3, 8, 0, 20, 2, 2), (5, 6, 0, 10, 4, 1), (6, 7, 0, 10, 5, 1)]
    edges = substr.sources(spark.createDataFrame(rows, "a long, b long, g int, doc_id long, start int, times int"))
    assert {r.node for r in substr.through_nodes(edges.where("occurrences > 1")).collect()} == {4}
    got = {(r.doc_id, r.start, r.n, r.occurrences) for r in substr.first_paths(edges).collect()}
    assert got == {(10, 0, 1, 3), (10, 1, 1, 3), (10, 2, 2, 3), (20, 0, 1, 2), (20, 2, 1, 2), (10, 4, 2, 1)}


def test_sources_take_the_least_document(spark):
    rows = [(1, 2, 0, 30, 7, 1), (1, 2, 0, 10, 5, 2), (1, 2, 1, 4, 0, 1)]
    got = substr.sources(spark.createDataFrame(rows, "a long, b long, g int, doc_id long, start int, times int")).collect()
    assert sorted((r.doc_id, r.start, r.occurrences) for r in got) == [(4, 0, 1), (10, 5, 3)]


def test_spans_of_equal_edges_have_equal_words(monkeypatch):
    """Hashes that tell no words apart are caught by the digests of the words; sound ones are not."""
    import pyarrow as pa

    texts = [" ".join(f"{c}{i}" for i in range(60)).encode() for c in "ab"] * 2
    whole = pa.array([[{"start": 0, "n": 41}]] * 4, pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())])))
    batch = pa.record_batch([pa.array([t.decode() for t in texts]), whole], names=["text", "stretches"])

    def seen():
        spans = {}
        for out in substr._spans(20, 0)(iter([batch])):
            for r in out.to_pylist():
                spans.setdefault(r["edges"], set()).add(r["words"])
        return spans

    assert seen() and all(len(w) == 1 for w in seen().values())
    monkeypatch.setattr(words_of.Words, "hashes", lambda self, lower=False, seed=0: substr.np.arange(len(self.starts), dtype=substr.np.uint64) % substr.np.uint64(60))
    assert any(len(w) > 1 for w in seen().values())


def test_clashing_spans_are_hashed_anew(spark, monkeypatch):
    said = iter([False, True])
    asked = []
    real = substr.clashes
    monkeypatch.setattr(substr, "clashes", lambda spans: asked.append(1) or (real(spans) if next(said) else spark.range(1)))
    rows = [(1, " ".join(f"w{i}" for i in range(30))), (2, "z " + " ".join(f"w{i}" for i in range(30)))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in passage_digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _removed(rows) and len(asked) == 2


def test_texts_without_repeats_with_clashing_columns(spark):
    p = " ".join(f"w{i}" for i in range(25))
    rows = [(1, p, 1, b"x", "k", 4), (2, f"b {p}", 2, b"y", "l", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id int, _fp binary, kept string, _Kept int")
    out = without_repeats(df)
    assert out.columns == df.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, p, 1, bytearray(b"x"), "k", 4), (2, "b", 2, bytearray(b"y"), "l", 5)]
