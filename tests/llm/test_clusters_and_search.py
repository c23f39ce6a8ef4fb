import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from repsmith.llm import bag_ranking, sharded_lloyd
from repsmith.llm._text import same_bytes

VECTORS = "vec_id long, embedding array<double>, chunk string, block string, cluster string"


def vectors_of(spark, rows):
    """With further columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], VECTORS).repartition(5)


def brute_lloyd(rows, dims, clusters, rounds):
    kept = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1].tolist()))
    centroids = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((int(((v - c) ** 2).sum()), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), c in zip(kept, own) if c == j]
            if mine:
                centroids[j] = np.array([int(s) // len(mine) for s in np.sum(mine, axis=0)])
    final = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, c, d in final:
        per[c] += d
    return sorted((-1 if i is None else i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in final)


@pytest.mark.parametrize("dims,clusters", [(64, 16), (40, 3), (5, 200)])
def test_lloyd_equals_brute_force(spark, monkeypatch, dims, clusters):
    monkeypatch.setattr(sharded_lloyd, "TILE_ROWS", 50)
    rng = np.random.default_rng(dims)
    rows = [(i, (rng.normal(size=dims) * rng.choice([0.3, 5, 4000])).tolist()) for i in range(180)]
    rows += [(500, [1.0] * dims)] * 30 + [(600 + i, [1.0] * dims) for i in range(30)] + [(None, [0.25] * dims), (None, [-3.5] * dims)]
    rows += [(700, None), (701, [1.0] * (dims + 1)), (702, []), (703, [float("nan")] + [1.0] * (dims - 1)), (704, [None] + [1.0] * (dims - 1)), (705, [float("-inf")] * dims)]
    got = sharded_lloyd.lloyd(vectors_of(spark, rows), dims, clusters, 3).collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id, *r[1:]) for r in got) == brute_lloyd(rows, dims, clusters, 3)


def test_lloyd_empty_and_too_large(spark):
    assert sharded_lloyd.lloyd(vectors_of(spark, []), 64, 16, 3).count() == 0
    assert sharded_lloyd.lloyd(vectors_of(spark, [(1, None), (2, [1.0])]), 64, 16, 3).count() == 0
    with pytest.raises(Exception, match="no squared distance"):
        sharded_lloyd.lloyd(vectors_of(spark, [(1, [1e30] * 64)]), 64, 16, 3)


def test_a_cluster_without_rows_keeps_its_slice(spark):
    stored = sharded_lloyd.tiles(vectors_of(spark, [(i, [float(i), 0.0]) for i in range(4)]), 2, 2, "1")
    slices = spark.createDataFrame([(0, 0, 0, 64), (0, 0, 1, 0), (0, 1, 0, 6400), (0, 1, 1, 7)], "block int, cluster int, d int, value long")
    moved = sharded_lloyd.update(stored, sharded_lloyd.assign(stored, slices), slices)
    assert sorted(map(tuple, moved.collect())) == [(0, 0, 0, 96), (0, 0, 1, 0), (0, 1, 0, 6400), (0, 1, 1, 7)]


DOCS = "doc_id long, text string, n string, m string, counts string"
ITEMS = "item_id long, text string, rank string, score string"


def brute_rank(docs, items, top):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda x: x[0].lower(), t or ""))
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n, length = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, words in wanted.items():
        scores = []
        for d, b in bags:
            m = 50 + (50 * sum(b.values()) * n) // max(length, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10 ** 9 * b[w]) // (1000 * b[w] + 20 * m)) for w in words if b[w])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(-1 if i is None else i, k + 1, -1 if late else d, -s) for k, (s, late, d) in enumerate(sorted(scores)[:top])]
    return sorted(out)


def ranked(spark, docs, items, top):
    d = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in docs], DOCS).repartition(6)
    q = spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)
    return sorted((-1 if r.item_id is None else r.item_id, r["rank"], -1 if r.doc_id is None else r.doc_id, r.score) for r in bag_ranking.rank(d, q, top).collect())


@pytest.mark.parametrize("block,pairs", [(1 << 20, 1 << 21), (9, 7)])
def test_ranking_equals_brute_force(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(bag_ranking, "ITEM_TERMS", block)
    monkeypatch.setattr(bag_ranking, "PAIRS", pairs)
    rnd = random.Random(3)
    words = ["alpha", "Beta", "été", "x1", "日本", "z", "\x7f", "the", "the", "the", "É"]
    text = lambda k: " ".join(rnd.choice(words) + rnd.choice(["", ",", "-y", "'s"]) for _ in range(k))
    docs = [(i, text(rnd.randint(0, 30))) for i in range(150)]
    docs += [(1000 + i, "The alpha, THE x1!") for i in range(40)] + [(7, "The alpha, THE x1!")] * 3 + [(None, "the alpha the x1"), (None, "z")]
    docs += [(2000, None), (2001, ""), (2002, "\x00\x01 .,;"), (2003, "alpha " * 30000), (2004, "y" * 2_000_000 + " z")]
    items = [(i, text(rnd.randint(1, 6))) for i in range(8)] + [(20, "the alpha"), (20, "z"), (21, None), (22, "..."), (None, "Z x1"), (23, "nowhere")]
    assert ranked(spark, docs, items, 12) == brute_rank(docs, items, 12)


def test_ranking_of_empty_tables(spark):
    assert ranked(spark, [], [(1, "a")], 5) == [] and ranked(spark, [(1, "a")], [], 5) == [] and ranked(spark, [(1, None), (2, "..")], [(1, "a")], 5) == []


def test_equal_bags_form_one_class(spark):
    docs = spark.createDataFrame([(i, "a b a") for i in range(30)] + [(50, "b a a"), (51, "a b"), (52, "a b a q")], "doc_id long, text string")
    counted = bag_ranking.word_counts(docs, ["a", "b"])
    rows = sorted((len(r.members), r.members[0]) for r in bag_ranking.classes(counted, 33, 99, 20).collect())
    assert rows == [(1, 51), (1, 52), (20, 0)]


def test_same_bytes():
    a, b = np.frombuffer(b"onetwothree", np.uint8), np.frombuffer(b"twoonethrex", np.uint8)
    starts = lambda *x: np.array(x)
    assert same_bytes(a, starts(0, 3, 6, 0), starts(3, 6, 11, 0), b, starts(3, 0, 6, 4), starts(6, 3, 11, 4)).tolist() == [True, True, False, True]
    assert same_bytes(a, starts(0, 3), starts(0, 3), b, starts(1, 2), starts(1, 2)).tolist() == [True, True]
