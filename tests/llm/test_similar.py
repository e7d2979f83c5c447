import random

import duckdb
import numpy as np
import pytest

from tickweave.llm import similar, simhash

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
D = "/root/testdata/sf0.001"


def shingles(text):
    w = (text or "").translate(LOW).split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def planted():
    """Texts, copies with edited words, shortened and lengthened ones, some just under the similarity, a chain, and short texts."""
    rnd, own = random.Random(5), duckdb.connect().execute(f"select text from '{D}/documents.parquet' where text is not null order by doc_id limit 300").fetchall()
    out = [t for (t,) in own]
    for (t,) in own:
        w = t.split()
        for _ in range(rnd.randint(0, 4)):
            c = list(w)
            for _ in range(rnd.randint(0, max(1, len(w) // 30))):
                c[rnd.randrange(len(c))] = f"w{rnd.randrange(10**6)}"
            out.append(" ".join(c[: len(c) - rnd.randint(0, len(c) // 6)]))
    many = [f"m{i}" for i in range(120)]
    out += [" ".join([*many[: 100 + i % 20], f"x{i}"]) for i in range(150)]  # one large group
    chain = [f"c{i}" for i in range(200)]
    out += [" ".join(chain[5 * i : 5 * i + 100]) for i in range(20)]
    return [*out, "a b c d e f g h i", "a b c d e f g h", "A b c", "a  b c", "a b d", "", " ", None]


@pytest.mark.parametrize("size", [similar.SLICE, 7])
def test_pipeline_near_stage(spark, size):
    texts = planted()
    sets = [shingles(t) for t in texts]
    u, v = [], []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 5 * both >= 4 * (len(a) + len(sets[j]) - both):
                u.append(i)
                v.append(j)
    label = simhash.components_of(len(texts), np.array(u), np.array(v)).tolist()
    assert len(set(label)) < len(texts) - 400
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.component_id for r in similar.similar_groups(docs, size=size).collect()} == dict(enumerate(label))
    if size == similar.SLICE:
        import corpus_pipeline

        left = corpus_pipeline.keep_one_of_near_copies(spark, docs, D)
        assert sorted(r.doc_id for r in left.collect()) == sorted(set(label))


def test_odd_ids(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, "x y"), (3, "p q r s t u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert similar.similar_groups(docs).count() == 5 and similar.drop_near(docs).count() == 5
    assert similar.drop_near(docs.limit(0)).count() == 0
