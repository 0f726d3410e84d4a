import corpus_pipeline
from sluice.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        left = docs.count()
        assert 0 < left <= n
        n = left


def test_run_packs_what_is_left(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[0] == "doc_id" and out.count() > 0


def test_every_operator_has_its_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.queries()) == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_run_equals_brute_force(spark, tmp_path):
    """Everything but the quality model's own scores is made again by hand."""
    import random
    import zlib
    from collections import Counter

    import numpy as np
    from tokenizers import Tokenizer

    from sluice.llm.packing import public_tokenizer
    from sluice.llm.quality import quality
    from tests.llm.conftest import SCHEMA, words
    from tests.llm.test_dedup import _components

    rng = random.Random(11)
    items = [" ".join(words(rng, n)) for n in (12, 30)]
    passage = " ".join(words(rng, 40))
    rows = []
    for i in range(160):
        text = " ".join(words(rng, rng.randint(30, 80)))
        text = f"{text} {passage}" if i % 10 == 3 else f"{text} {items[i % 2]} end" if i % 10 == 5 else rows[i - 4][1] + " more" if i % 10 == 7 else text
        rows.append((i, " ".join(w + "%%" for w in text.split()) if i % 4 == 0 else text, "en", "s", len(text)))
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    scored = quality(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet"))).collect()
    good = {r.doc_id for r in scored if r.predicted}
    assert good == {i for i in range(160) if i % 4}
    left = [(r[0], r[1]) for r in rows if r[0] in good]
    kept = _components(left)
    left = [r for r in left if kept[r[0]][2]]
    seen, texts = set(), {}
    for i, t in left:
        w = t.split()
        gone = [False] * len(w)
        for j in range(len(w) - 19):
            key = tuple(w[j : j + 20])
            if key in seen:
                gone[j : j + 20] = [True] * 20
            seen.add(key)
        texts[i] = " ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else t
    shingles = lambda w: Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4)))

    def leaks(t):
        w = t.lower().split()
        for it in (x.split() for x in items):
            for p in range(len(w) - len(it) + 1):
                a, b = shingles(w[p : p + len(it)]), shingles(it)
                same = (a & b).total()
                if 100 * same >= 75 * (a.total() + b.total() - same):
                    return True
        return False

    texts = {i: t for i, t in texts.items() if not leaks(t)}
    tok = Tokenizer.from_str(public_tokenizer())
    ids = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in texts.items()}
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: len(x) for i, x in ids.items()}
    assert 20 < len(got) < len(good)
