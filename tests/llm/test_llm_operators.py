"""The training-data operators against brute force, and their edge cases, on small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import (
    components,
    decontaminate,
    line_dedup,
    near_dedup,
    pieces,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    texts,
    token_records,
    toxicity,
)
from ledgerlark.llm.book import PIECE_TOKENIZER, WORD_TOKENIZER, tokenizer_path
from ledgerlark.session import ship_package

DOCS = "doc_id bigint, text string"
WORDS = [
    a + b
    for a in ("", "un", "re", "over", "de", "mis", "sub", "pre")
    for b in "the of and in river stone paper lamp green walk seven quiet under north glass table bread".split()
]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ","]) for _ in range(n))


def docs_of(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(prose(i, 500) for i in range(40))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t"),
        (4, prose(1, 80)),
        (5, prose(1, 80)),
        (6, long),
        (7, "a▁b 日本 \U0001d11e  x\n\n y "),
        (8, prose(2, 30) + "\n" + prose(1, 80)),
        (9, "word"),
    ]


# --- helpers ------------------------------------------------------------------------------


def test_word_hashes_tell_words_apart_and_cut_long_texts(monkeypatch):
    rows = [prose(i, 50).encode() for i in range(5)] + [b"", b" \n", prose(9, 3000).encode()]
    whole, places = texts.word_hashes(rows)
    monkeypatch.setattr(texts, "BLOCK", 64)
    cut, cut_places = texts.word_hashes(rows)
    assert (whole == cut).all() and (places == cut_places).all()
    words = [w for r in rows for w in r.split()]
    assert len(words) == len(whole)
    assert len(set(words)) == len(set(whole.tolist())) == len(set(zip(words, whole.tolist(), strict=True)))


def test_components_are_those_of_a_search(spark):
    rng = random.Random(4)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)]
    links = [x for x in links if x[0] != x[1]]
    near = collections.defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for i in sorted(near):
        todo = [i] if i not in want else []
        while todo:
            j = todo.pop()
            if j not in want:
                want[j] = i
                todo += near[j]
    got = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["id"]: r["component"] for r in got} == want and len(got) == len(want)


# --- 1 ------------------------------------------------------------------------------------


def brute_lines(rows):
    space = "\x20\t\n\x0b\x0c\r"
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = collections.defaultdict(list)
    for doc, text in rows:
        for key in {x.strip(space).translate(low) for x in (text or "").split("\n")}:
            if len(key) >= 40:
                held[key].append(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keys = [x.strip(space).translate(low) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if len(held[k]) < 5 or max(held[k]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_LIMIT, 0])
def test_line_dedup_against_brute_force(spark, limit):
    shared = ["É" * 40, "A" * 39, "Mixed CASE line that many documents hold, over forty signs", "x" * 200]
    rng = random.Random(1)
    rows = [r for r in odd_rows() if r[0] is not None]
    for i in range(20, 60):
        lines = [prose(i, 12)] + [rng.choice(["", "  ", "\t"]) + rng.choice([s, s.upper()]) for s in shared if rng.random() < 0.7]
        rows.append((i, "\n".join(lines * rng.choice([1, 2]))))
    got = line_dedup.dedup_lines(docs_of(spark, rows), broadcast_limit=limit, shard_keys=2)
    found = sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect())
    assert found == brute_lines(rows)


def test_line_dedup_null_ids_clashing_columns_and_empty(spark):
    line = "a line that is long enough to be looked at by the rule"
    rows = [(None, line, "k")] * 3 + [(i, line, "k") for i in (1, 2)]
    docs = docs_of(spark, rows, "doc_id bigint, text string, n_lines string")
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {None: 1, 1: 1, 2: 0}
    alone = line_dedup.dedup_lines(docs_of(spark, [(None, line)] * 6)).collect()
    assert [r["n_dropped"] for r in alone] == [0] * 6
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_LIMIT, 0])
def test_line_dedup_judges_rows_of_one_id_and_of_none_by_themselves(spark, limit):
    line = "a line that is long enough to be looked at by the rule"
    rows = [(None, f"{line}\nalpha"), (None, f"beta\n{line}"), (None, "gamma\ndelta"), (None, f"beta\n{line}")]
    rows += [(1, f"{line}\nepsilon"), (1, f"zeta\n{line}"), (1, "eta\ntheta"), (1, None), (2, line), (3, line)]
    docs = docs_of(spark, rows)
    got = line_dedup.dedup_lines(docs, broadcast_limit=limit, shard_keys=2)
    assert got.columns[:2] == docs.columns
    want = [("" if t is None else t) if d == 3 else "\n".join(x for x in (t or "").split("\n") if x != line) for d, t in rows]
    key = lambda r: (r[0] or 0, *r[1:])
    found = [(r["doc_id"], r["text"] or "", r["kept_text"]) for r in got.collect()]
    assert sorted(found, key=key) == sorted(((d, t or "", k) for (d, t), k in zip(rows, want, strict=True)), key=key)


def test_perfect_hash_has_no_gap_and_no_clash():
    for n in (1, 2, 3, 50, 5000):
        low = texts.mix(np.arange(n, dtype=np.uint64))
        d = line_dedup.build_mph(low)
        slots = line_dedup._slot(low, d[line_dedup._bucket_of(low, n)], n)
        assert sorted(slots.tolist()) == list(range(n))


def test_a_hot_line_meets_many_copies_of_its_shard(spark):
    hot = "the very same boilerplate line in a third of all documents"
    rows = [(i, f"{prose(i, 9)}\n{hot}\n{prose(i + 1, 9)}" if i % 3 else prose(i, 12)) for i in range(90)]
    rows += [(None, f"{hot}\nx"), (None, f"{hot}\nx"), (7, f"y\n{hot}"), (500, None)]

    def kept(**limits):
        got = line_dedup.dedup_lines(docs_of(spark, rows), **limits).collect()
        return sorted((r["doc_id"] or -1, r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got)

    once = kept()
    assert sum(hot in r[3] for r in once) == 1
    assert kept(broadcast_limit=0, group_bytes=200) == once == kept(broadcast_limit=0)


# --- 2 ------------------------------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_against_brute_force():
    rows = [t for _, t in odd_rows()] + ["a b c d e " * 4, "x #|<>\nx #|<>\n \n", "éé 日", prose(3, 40) + " " + prose(3, 40)]
    got = quality_rules.measures([(t or "").encode() for t in rows])
    assert [tuple(int(got[m][i]) for m in quality_rules.MEASURES) for i in range(len(rows))] == [brute_measures(t) for t in rows]


def test_quality_rules_keep_clean_texts_and_reject_marks(spark):
    rows = [(i, prose(i, 60)) for i in range(60)]
    rows += [(100 + i, " ".join(w + "%%%" for w in prose(i, 60).split())) for i in range(10)]
    rows += [(200, None), (201, ""), (202, "too short"), (203, "again and again and " * 30)]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame(
        [(i, 1) for i in range(0, 60, 2)] + [(100, 0), (None, 1), (4, None), (999, 1), (6, 1)], "doc_id bigint, quality int"
    )
    ratios = quality_rules.train(quality_rules.marked_trusted(docs, labels), bits=12)
    got = {r["doc_id"]: r for r in quality_rules.judge(docs.withColumn("kept", F.lit(7)), ratios).collect()}
    assert all(got[i]["kept"] for i in range(60))
    assert not any(got[i]["kept"] for i in range(100, 110))
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in range(200, 204))


def test_quality_ratio_is_the_mean_over_ngrams(spark):
    rows = [(i, prose(i, 40)) for i in range(12)]
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id bigint, quality int")
    bits, prior = 12, quality_rules.PRIOR
    ratios = quality_rules.train(quality_rules.marked_trusted(docs, labels), bits=bits)
    raw, trusted = np.zeros(1 << bits), np.zeros(1 << bits)
    per = {}
    for i, t in rows:
        grams, _ = quality_rules.features([t.encode()], bits)
        per[i] = grams
        np.add.at(raw, grams, 1)
        if i < 5:
            np.add.at(trusted, grams, 1)
    q = trusted.sum() / raw.sum()
    want = np.log((trusted + prior * q) / ((raw + prior) * q))
    for r in quality_rules.judge(docs, ratios).collect():
        assert math.isclose(r["llr"], want[per[r["doc_id"]]].mean(), abs_tol=1e-5)
    untrained = quality_rules.train(quality_rules.marked_trusted(docs, labels.limit(0)), bits=bits)
    assert not untrained.any()
    assert quality_rules.judge(docs.limit(0), ratios).count() == 0


# --- 3 ------------------------------------------------------------------------------------


def bag(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else collections.Counter([tuple(w)] if w else [])


def brute_classes(rows):
    bags = {i: bag(t) for i, t in rows}
    par = {i: i for i in bags}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    ids = sorted(bags)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = sum((bags[a] & bags[b]).values())
            if bags[a] and both >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                x, y = find(a), find(b)
                par[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(text, seed, n):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_near_classes_against_brute_force(spark):
    rows = odd_rows()
    for g in range(6):
        base = prose(50 + g, 120) + f" unique{g}"
        rows += [(1000 * (g + 1) + k, edited(base, k, k % 4)) for k in range(15)]
    rows += [(9000 + k, "one two") for k in range(3)] + [(9100, "two one")]
    got = near_dedup.near_classes(docs_of(spark, rows + [(None, rows[3][1])])).collect()
    want = brute_classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    sizes = collections.Counter(want.values())
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got) and len(got) == len(rows)


def test_near_pairs_behind_hubs_without_links(spark):
    base = prose(80, 60)
    texts = [base + " " + prose(81 + k, 25) for k in range(60)]
    key = lambda t: int(near_dedup.band_keys(near_dedup.signatures(*near_dedup.bags([t.encode()]), 1, 1), 1, 1)[0, 0])
    common, n = collections.Counter(map(key, texts)).most_common(1)[0]
    texts = [t for t in texts if key(t) == common]
    twin = next(t for t in (f"{texts[-1].rsplit(' ', 1)[0]} twin{i}" for i in range(50)) if key(t) == common)
    rows = list(enumerate([*texts, twin], 1))  # the two that are linked come last
    assert n >= 20
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs_of(spark, rows), bands=1, rows=1).collect()}
    want = brute_classes(rows)
    assert want[n + 1] == n and got == want


def test_sketches_differ_in_no_more_bits_than_bags():
    texts = [edited(prose(70, 300) + " one" * 20, k, 3 * k) for k in range(12)]
    sketches = near_dedup.parities(*near_dedup.bags([t.encode() for t in texts]), len(texts))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            x, y = bag(a), bag(b)
            bits = sum(int(v).bit_count() for v in sketches[i] ^ sketches[j])
            assert bits <= sum(((x - y) + (y - x)).values())


def test_near_classes_of_nothing_and_of_lone_texts(spark):
    assert near_dedup.near_classes(docs_of(spark, [])).count() == 0
    lone = near_dedup.near_classes(docs_of(spark, [(1, None), (2, ""), (3, prose(1, 30))])).collect()
    assert sorted((r["doc_id"], r["class_id"], r["class_size"]) for r in lone) == [(1, 1, 1), (2, 2, 1), (3, 3, 1)]


def test_registers_estimate_weighted_jaccard():
    a = " ".join(prose(1, 400).split() * 2 + prose(2, 100).split())
    b = " ".join(prose(1, 400).split() + prose(3, 100).split())
    x, y = bag(a), bag(b)
    true = sum((x & y).values()) / sum((x | y).values())
    m = 4096
    registers = near_dedup.signatures(*near_dedup.bags([a.encode(), b.encode()]), 2, m)
    share = float((registers[0] == registers[1]).mean())
    assert abs(share - true) < 5 * math.sqrt(true * (1 - true) / m)


# --- 4 ------------------------------------------------------------------------------------


def test_shards_have_equal_rows_and_the_mixture(spark):
    rng = random.Random(2)
    rows = [(i, prose(i, rng.randrange(1, 30)), rng.choice(["a"] * 6 + ["b", "b", "c", None])) for i in range(1003)]
    rows += [(2000, None, "c"), (2001, "", None), (7, rows[7][1], rows[7][2])]
    got = sharding.interleave(docs_of(spark, rows, DOCS + ", source string").withColumn("shard", F.lit("x"))).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r[0] for r in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    counts = [len(v) for v in by.values()]
    assert len(by) == 8 and max(counts) - min(counts) <= 1
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in by.values())
    of = collections.Counter(r[2] for r in rows)
    for v in by.values():
        for source, n in collections.Counter(r["source"] for r in v).items():
            assert abs(n - of[source] / 8) <= 2
    text = dict((i, t) for i, t, _ in rows)
    for r in got:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    again = sharding.interleave(docs_of(spark, rows[::-1], DOCS + ", source string")).collect()
    place = lambda rs: {(r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in rs}
    assert place(again) == place(got)
    assert sharding.interleave(docs_of(spark, [], DOCS + ", source string")).count() == 0


# --- 5, 8 -----------------------------------------------------------------------------------


def labelled_rows(n, mark):
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        words = prose(i, 60).split()
        if bad:
            words = mark(words, i)
        rows.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(bad)))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_classifier_on_the_held_out_fold(spark):
    rows, labels = labelled_rows(300, lambda w, i: [x + "###" for x in w])
    docs = docs_of(spark, rows + [(900, None), (901, ""), (902, " ".join(r[1] for r in rows))])
    known = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    weights = quality_classifier.train(docs, known, "quality", bits=14)
    got = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, weights).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 303
    assert all((got[i] >= 0.5) == bool(q) for i, q, _ in labels if held(i))
    assert got[900] == got[901]
    # Labels of the held-out fold play no part.
    wrong = known.withColumn("quality", F.when(quality_classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality_classifier.train(docs, wrong, "quality", bits=14) == weights).all()
    none = quality_classifier.train(docs, known.limit(0), "quality", bits=14)
    assert {r["score"] for r in quality_classifier.score(docs, none).collect()} == {0.5}
    assert quality_classifier.score(docs.limit(0), weights).count() == 0


def test_toxicity_on_the_held_out_fold(spark):
    bad = ["scoundrel", "scoundrels", "wretch"]
    rows, labels = labelled_rows(400, lambda w, i: w[:20] + [bad[i % 3]] + w[20:40] + [bad[(i + 1) % 3]] + w[40:])
    docs = docs_of(spark, rows + [(900, None), (901, "")]).withColumn("score", F.lit("mine"))
    known = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, known).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 402
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in labels if held(i))
    assert got[900] == got[901] < 0.5
    assert {r["doc_id"] for r in toxicity.score(docs, known.limit(0)).collect()} == set(got)
    assert toxicity.score(docs.limit(0), known).count() == 0


def test_short_and_wholly_toxic_texts_are_toxic(spark):
    bad = ["scoundrel", "scoundrels", "wretch"]
    rows, labels = labelled_rows(400, lambda w, i: w[:20] + [bad[i // 3 % 3]] + w[20:40] + [bad[(i // 3 + 1) % 3]] + w[40:])
    dense = ["wretch", "scoundrel scoundrel scoundrel", "wretch scoundrels " * 30, f"wretch wretch {prose(5, 1)}"]
    rows += [*((900 + k, t) for k, t in enumerate(dense)), (950, ""), (951, prose(6, 1)), (952, prose(7, 60))]
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs_of(spark, rows), known).collect()}
    assert all(got[900 + k] >= 0.5 for k in range(len(dense))) and all(got[950 + k] < 0.5 for k in range(3))


def test_toxicity_scores_with_any_size_of_the_table(spark):
    bad = ["scoundrel", "scoundrels", "wretch"]
    rows, labels = labelled_rows(300, lambda w, i: w[:20] + [bad[i % 3]] + w[20:40] + [bad[(i + 1) % 3]] + w[40:])
    rows += [*((900 + k, rows[3 * k][1]) for k in range(5)), (950, None), (951, ""), (None, "wretch wretch")]
    docs = docs_of(spark, rows).withColumns({"key": F.lit(1), "stem": F.lit("x"), "more": F.lit(2.0)})
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")

    def scores(table_rows):
        got = toxicity.score(docs, known, table_rows=table_rows)
        assert got.columns == [*docs.columns, "score"]
        return sorted((r["doc_id"] or -1, round(r["score"], 9)) for r in got.collect())

    assert scores(3) == scores(40) == scores(1 << 19)


def test_toxic_words_of_other_scripts(spark):
    rng, rows, labels = random.Random(8), [], []
    words = ["".join(rng.choices("бвгдежзиклмнопрст", k=rng.randrange(2, 9))) for _ in range(150)]
    words += ["дурная", *("".join(rng.choices("城市和河流山水天地人", k=6)) for _ in range(30))]
    for i in range(400):
        text = rng.choices(words, k=40)
        if i % 3 == 0:
            text[10], text[30] = "дурак", "城笨蛋市"
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 3 == 0)))
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs_of(spark, rows), known).collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in labels if held(i))
    first, second = toxicity.stems(["дурак дурная".encode()])[0]
    assert first != second and len(toxicity.stems(["城市和河".encode()])[0]) == 4


def test_toxic_raw_scores_count_evidence_for_either_class():
    stem = toxicity.stems([b"wretch kindly"])[0]
    models = toxicity.Models(stem, np.array([5.0, -5.0], np.float32), 0.5, 0.5)
    raw = toxicity.raw_scores(models, [b"wretch", b"", b"other words", b"kindly", b"wretch kindly"])
    beyond = 4.5 - toxicity.DEAD_ZONE, -5.5 + toxicity.DEAD_ZONE
    assert raw.tolist() == [beyond[0], 0, 0, beyond[1], sum(beyond) / 2]


def test_toxic_models_sum_to_one(spark):
    rows, labels = labelled_rows(60, lambda w, i: [*w, "wretch"])
    docs = docs_of(spark, rows)
    known = toxicity.labelled(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    models = toxicity.count_models(docs, known)
    seen = collections.defaultdict(set), collections.defaultdict(set)
    fold = {r["id"]: (r["fold"], r["toxic"]) for r in known.collect()}
    for i, t in rows:
        if i in fold and fold[i][0] < 4:
            before = ""
            for w in re.findall(r"[a-z]+", t):
                seen[fold[i][1]][w[: toxicity.STEM]].add(before)
                before = w[: toxicity.STEM]
    stems = sorted(set(seen[0]) | set(seen[1]))
    n = [{w: len(s.get(w, ())) for w in stems} for s in seen]
    both = {w: len(seen[0].get(w, set()) | seen[1].get(w, set())) for w in stems}
    log = []
    for c in (0, 1):
        total = sum(n[c].values())
        first = {w: max(0, n[c][w] - toxicity.DISCOUNT) / total for w in stems}
        rest = 1 - sum(first.values())
        p = {w: first[w] + rest * both[w] / sum(both.values()) for w in stems}
        assert math.isclose(sum(p.values()), 1)
        log.append(p)
    numbers, _ = toxicity.stems([" ".join(stems).encode()])
    want = [math.log(log[1][w] / log[0][w]) for w in stems]
    assert np.allclose(models.difference(numbers), want, atol=1e-4)


# --- 6 ------------------------------------------------------------------------------------


def brute_contaminated(rows, items, threshold, overlap):
    weighed = decontaminate.weigh([(i, *decontaminate.split_item(t)) for i, t in items])
    out = set()
    for index in decontaminate.indexes([(i, *decontaminate.split_item(t)) for i, t in items]):
        cell = index.longest
        mine = [w for w in weighed if w.item_id in index.ids]
        for doc, text in rows:
            hashes, _ = decontaminate.tokens([(text or "").encode()])
            for start in range(0, max(1, len(hashes)), cell):
                passage = hashes[start : start + 2 * cell]
                terms = set(passage.tolist())
                for item in mine:
                    score = sum(x for t, x in item.impacts.items() if t in terms)
                    if score >= threshold - 1e-12:
                        grams: dict = {}
                        if min(decontaminate._overlap(p, grams, passage) for p in item.parts) >= overlap:
                            out.add((doc, item.item_id))
    return out


def test_contaminated_against_brute_force(spark):
    items = [(k, prose(500 + k, 12 + 3 * k) + (f"\nanswer {prose(700 + k, 4)}" if k % 2 else "")) for k in range(14)]
    items += [(50, "too short"), (51, None), (52, ""), (60, items[3][1])]
    rows = odd_rows()
    for k, t in items[:14]:
        rows.append((100 + k, prose(k, 70) + " " + t.upper().replace(" ", "  ") + " " + prose(k + 1, 33)))
        rows.append((200 + k, prose(k, 70) + " " + edited(t, k, 1)))
        rows.append((300 + k, " ".join(t.split()[: len(t.split()) // 2])))
        rows.append((400 + k, " ".join(sorted(t.split()))))
    docs, table = docs_of(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_contaminated(rows, [i for i in items if i[1]], decontaminate.THRESHOLD, decontaminate.OVERLAP)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, table).collect()}
    assert got == want
    assert {(100 + k, k) for k in range(14)} <= got and not any(300 <= d < 400 for d, _ in got)
    # Items in several parts: each is found still.
    parts = decontaminate.contaminated(docs, table, part_bytes=300)
    assert {(100 + k, k) for k in range(14)} <= {(r["doc_id"], r["item_id"]) for r in parts.collect()}
    assert decontaminate.contaminated(docs, table.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), table).count() == 0


def test_many_parts_of_items_give_the_rows_of_one(spark):
    items = [(k, prose(500 + k % 9, 12 + 3 * k) + f"\nanswer {prose(700 + k, 4)}") for k in range(30)]
    rows = [(100 + k, prose(k, 70) + " " + edited(t, k, 1 + k % 9) + " " + prose(k + 1, 20)) for k, t in items]
    docs, table = docs_of(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")

    def found(part_bytes):
        got = decontaminate.contaminated(docs, table, 0.5, 0.5, part_bytes).collect()
        return sorted((r["doc_id"], r["item_id"], *(round(r[c], 9) for c in r.asDict() if c[-2:] != "id")) for r in got)

    one = found(1 << 20)
    assert len(one) > 10 and found(400) == one and found(2000) == one


def test_items_without_blanks_and_short_items(spark):
    chinese = "长江是中国最长的河流它从青藏高原流入东海"
    thai = "แม่น้ำเจ้าพระยาไหลผ่านกรุงเทพมหานคร"
    items = [(1, chinese), (2, thai), (3, "Forty\nTwo"), (4, "yes"), (5, "黄河"), (6, "--"), (7, "yes")]
    rows = [
        (1, "我们知道" + chinese + "。"),
        (2, "ok " + thai),
        (3, "a line\n forty two! \nyes\nmore"),
        (4, "the answer is forty two, yes"),
        (5, "forty\n\ntwo"),
        (6, "黄河"),
        (7, "黄河流入渤海" + prose(3, 30)),
        (8, None),
        (9, "长江流入东海"),
        (10, "so forty\ntwo"),
    ]
    found = decontaminate.contaminated(docs_of(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    want = {(1, 1), (2, 2), (3, 3), (3, 4), (3, 7), (5, 3), (6, 5)}
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_block_max_wand_finds_all_items_above_the_threshold(monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_POSTINGS", 3)
    items = decontaminate.weigh([(k, prose(k, 25), "") for k in range(80)])
    index = decontaminate.Index(items)
    rng = random.Random(3)
    for threshold in (0.2, 0.5, 0.8):
        for _ in range(30):
            query = np.array(sorted(rng.sample(range(len(index.terms)), rng.randrange(1, len(index.terms)))))
            chosen = set(index.terms[query].tolist())
            want = {i for i, x in enumerate(items) if sum(v for t, v in x.impacts.items() if t in chosen) >= threshold}
            assert {i for i, _ in decontaminate.block_max_wand(index, query, threshold)} == want


def test_questions_and_answers_in_columns(spark):
    items = spark.createDataFrame([(1, prose(1, 20), "forty two"), (2, prose(2, 20), None)], "item_id int, question string, answer string")
    docs = docs_of(spark, [(1, prose(1, 20)), (2, prose(1, 20) + " forty two"), (3, prose(2, 20))])
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()} == {(2, 1), (3, 2)}


# --- 7 ------------------------------------------------------------------------------------


def brute_substrings(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone, strict=False) if not g)
        spans = int((np.diff(np.append(False, gone[:-1]).astype(int)) == 1).sum()) if len(raw) else 0
        out[doc] = (len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_substrings_against_brute_force(spark, monkeypatch):
    passage = prose(77, 60)
    rows = odd_rows() + [(20 + i, prose(100 + i, 30) + passage + prose(200 + i, 10)) for i in range(12)]
    rows += [(50, "ab" * 400), (51, "ab" * 60), (52, passage + passage), (53, "é" * 99), (54, prose(5, 200)[:100])]
    rows += [(55, prose(5, 200)), (56, prose(5, 200)[1:100])]
    want = brute_substrings(rows)
    out = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    got = substring_dedup.dedup_substrings(docs_of(spark, rows).withColumn("removed", F.lit(1))).mapInArrow(substring_dedup.digest, out)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert substring_dedup.dedup_substrings(docs_of(spark, [])).count() == 0


def test_stretches_of_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(substring_dedup, "PART", 150)
    text = prose(3, 200).encode()
    parts = [p for block in substring_dedup._parts([text], [7], 100) for p in block]
    windows = [text[o + i : o + i + 100] for _, o, b in parts for i in range(len(b) - 99)]
    assert windows == [text[i : i + 100] for i in range(len(text) - 99)]


@pytest.mark.parametrize("seed", range(20))
def test_run_index_marks_all_windows_but_the_first(seed):
    rng = random.Random(seed)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 9))]
    seen: set[bytes] = set()
    for part, got in zip(parts, substring_dedup.repeated_windows(parts, 4), strict=True):
        want = []
        for i in range(len(part) - 3):
            if part[i : i + 4] in seen:
                want.append(i)
            seen.add(part[i : i + 4])
        assert got.tolist() == want


def test_run_index_is_short_for_repetitive_text():
    text = prose(1, 100).encode()
    parts = [text] * 30
    symbols = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int64) + 30, i) for i, p in enumerate(parts)])
    assert substring_dedup.RunIndex(symbols).runs < 3 * len(text)


# --- 9 ------------------------------------------------------------------------------------


def test_records_round_trip(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path(WORD_TOKENIZER))
    rows = odd_rows() + [(10, "It's 3.14! <|endoftext|> İstanbul STRASSE Été naïve, é café... x_y"), (None, "last")]
    folder, index = token_records.write_records(docs_of(spark, rows), tokenizer_path(WORD_TOKENIZER))
    index = token_records.with_starts(index)
    got = token_records.read_records(folder, index.orderBy(F.xxhash64("doc_id"))).collect()
    before = 0
    by = {r["doc_id"]: r for r in got}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [token_records.END_ID]
        assert by[doc]["ids"] == np.array(ids, "<u4").tobytes()
        assert (by[doc]["start"], by[doc]["n_tokens"]) == (before, len(ids))
        before += len(ids)
    assert token_records.write_records(docs_of(spark, []), tokenizer_path(WORD_TOKENIZER))[1].count() == 0


def test_damage_is_found():
    framed = token_records.record(5, 2, struct.pack("<HH", 3, 4))
    assert token_records.ids_of(framed, np.dtype("<u2")).tolist() == [3, 4]
    for i in range(len(framed)):
        with pytest.raises(ValueError):
            token_records.ids_of(framed[:i] + bytes([framed[i] ^ 1]) + framed[i + 1 :], np.dtype("<u2"))


# --- 10 -----------------------------------------------------------------------------------


def test_pieces_round_trip_and_best_score(spark):
    vocabulary = pieces.Vocabulary.load(tokenizer_path(PIECE_TOKENIZER))
    rows = odd_rows() + [(20, " lead  and trail "), (21, "\n"), (22, "a\n b\n"), (23, "▁"), (24, "naïve, $$$x")]
    docs = docs_of(spark, rows).withColumn("pieces", F.lit(1))
    path = tokenizer_path(PIECE_TOKENIZER)
    got = pieces.decode(pieces.encode(docs, path), path).collect()
    assert {r["doc_id"]: r["decoded"] for r in got} == {i: t or "" for i, t in rows}
    table, score = {}, {}
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            table[model.id_to_piece(i)] = i
        score[i] = vocabulary.byte_score if model.is_byte(i) else model.get_score(i)

    def best(marked):
        out = [0.0]
        for end in range(1, len(marked) + 1):
            options = [out[a] + score[table[marked[a:end]]] for a in range(max(0, end - 16), end) if marked[a:end] in table]
            if marked[end - 1] not in table:
                options.append(out[end - 1] + vocabulary.byte_score * len(marked[end - 1].encode()))
            out.append(max(options))
        return out[-1]

    for r in got:
        text = dict(rows)[r["doc_id"]] or ""
        if text and "▁" not in text and len(text) < 2000:
            assert math.isclose(sum(score[i] for i in r["pieces"]), best("▁" + text.replace(" ", "▁")), rel_tol=1e-12)
    assert [r["pieces"] for r in got if r["doc_id"] in (1, 2)] == [[], []]
    assert pieces.encode(docs.limit(0), path).count() == 0
