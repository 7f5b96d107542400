"""Near dedup of groups: large ones, chains of edits, texts that share an id, rows without id."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest

from ledgerlark.llm import near_dedup
from ledgerlark.session import ship_package

WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice(WORDS) for _ in range(n)]


def edited(words, seed, edits):
    rng, w = random.Random(seed), list(words)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return w


def bag(words):
    width = min(5, len(words))
    return collections.Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else collections.Counter()


def classes(rows):
    """{doc_id: class} by comparing all texts; texts of one id are linked."""
    texts = sorted({t or "" for _, t in rows})
    bags = [bag(t.split()) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            x, y = sum(a.values()), sum(b.values())
            if x and y and min(x, y) >= 0.8 * max(x, y):
                both = sum((a & b).values())
                if both >= 0.8 * (x + y - both):
                    parent[find(i)] = find(j)
    of_id = collections.defaultdict(list)
    for doc_id, t in rows:
        if doc_id is not None and (t or "").split():
            of_id[doc_id].append(texts.index(t))
    for nodes in of_id.values():
        for n in nodes[1:]:
            parent[find(n)] = find(nodes[0])
    least = {}
    for doc_id, nodes in of_id.items():
        c = find(nodes[0])
        least[c] = min(least.get(c, doc_id), doc_id)
    return {d: least[find(of_id[d][0])] if d in of_id else d for d, _ in rows if d is not None}


def check(spark, rows, **kw):
    got = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string"), **kw).collect()
    want = classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == want and len(got) == len(want)
    sizes = collections.Counter(want.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got)


def test_large_groups_and_chains(spark):
    base, far = prose(1, 150), prose(2, 150)
    rows = [(k, " ".join(edited(base, k, k % 5))) for k in range(400)]
    chain = far
    for k in range(60):  # each is near the one before, few are near the first
        chain = edited(chain, 1000 + k, 2)
        rows.append((1000 + k, " ".join(chain)))
    rows += [(2000 + k, " ".join(base[:100] + prose(3000 + k, 50))) for k in range(40)]  # share two thirds, are not near
    rows += [(3000 + k, " ".join(base)) for k in range(300)]
    random.Random(1).shuffle(rows)
    check(spark, rows)


def test_texts_of_one_id_and_rows_without_id_keep_their_links(spark):
    c, d, e = (" ".join(prose(k, 60)) for k in (11, 12, 13))
    close = " ".join(edited(e.split(), 5, 1)), " ".join(edited(edited(e.split(), 5, 1), 6, 1))
    rows = [(1, c), (2, c), (3, c), (3, d), (4, d), (4, d), (5, None), (5, d), (6, ""), (7, "one two"), (None, "one two")]
    rows += [(8, e), (None, close[0]), (9, close[1]), (None, None), (None, " ".join(prose(14, 60)))]
    check(spark, rows)


def test_blocks_of_a_bucket_meet(spark):
    base = prose(21, 60)
    texts = [" ".join(base + prose(100 + k, 22)) for k in range(2600)]  # in common buckets, mostly below the threshold
    twins = [t.rsplit(" ", 1)[0] + f" twin{k}" for k, t in enumerate(texts[::400])]
    rows = list(enumerate([*texts, *twins]))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string"), bands=2, rows=1).collect()}
    bags = [t.encode() for _, t in rows]
    keys = near_dedup.band_keys(near_dedup.signatures(*near_dedup.bags(bags), len(rows), 2), 2, 1)
    assert max(collections.Counter(keys[:, 0].tolist()).values()) > near_dedup.BLOCK
    met = sum(bool(set(keys[400 * k]) & set(keys[2600 + k])) and got[2600 + k] == 400 * k for k in range(len(twins)))
    assert met == sum(bool(set(keys[400 * k]) & set(keys[2600 + k])) for k in range(len(twins))) > 0


def test_what_sketches_leave_out_is_below_the_threshold():
    texts = [" ".join(edited(prose(31, 200), k, k)).encode() for k in range(40)]
    bags = near_dedup.bags(texts)
    parity = near_dedup.parities(*bags, len(texts))
    size = np.bincount(bags[1], bags[2], len(texts)).astype(np.int64)
    i, j = np.triu_indices(len(texts), 1)
    ok, _ = near_dedup.may_link(size, parity, i, j, 0.8)
    full = [np.sort(near_dedup.shingles([t])[0]) for t in texts]
    for a, b, may in zip(i, j, ok, strict=True):
        assert may or near_dedup.weighted_jaccard(full[a], full[b]) < 0.8
    assert not ok.all()
