import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from supplylens.llm import fingerprint, language_id, mixing, nearest, ngram_join, packing, ppm, queries, substring_dedup
from supplylens.llm import common
from supplylens.llm.common import fold, read
from supplylens.llm.fm_index import FMIndex
from tests.conftest import SMALL
from tests.llm import brute


def pairs(df, *names):
    return [tuple(r[n] for n in names) for r in df.select(*names).collect()]


def order(rows):
    return sorted(rows, key=repr)


# substring dedup


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=6))
def test_fm_index_counts_like_a_scan(text, pattern):
    flat = np.array([*text, 0], dtype=np.int64)
    index = FMIndex(flat, 5, 64, np.ones(len(flat), dtype=np.int64))
    lo, hi = np.array([0]), np.array([len(flat)])
    for s in reversed(pattern):
        lo, hi = index.step(np.array([s]), lo, hi)
    n = sum(text[i : i + len(pattern)] == pattern for i in range(len(text)))
    assert int(index.count(lo, hi)[0]) == n


def same_removal(df, rows, d):
    got = [(r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.removed(df, d).collect()]
    assert order(got) == order(brute.removed_words([t for _, t in rows], d.window))


def test_removal_matches_a_scan(documents, odd_documents):
    for df in (documents, odd_documents):
        same_removal(df, pairs(df, "doc_id", "text"), substring_dedup.Dedup())


def test_removal_with_a_crowded_minimizer(spark):
    rng = random.Random(1)
    passage = [f"p{i}" for i in range(50)]
    texts = []
    for i in range(60):
        own = [rng.choice("abcdefgh") + str(rng.randint(0, 40)) for _ in range(80)]
        texts.append((i, " ".join(own[:40] + passage + own[40:])))
    texts += [(100, texts[3][1].replace("p20", "other")), (101, " ".join(passage[:34]))]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for crowd in (5, 5000):
        same_removal(df, texts, substring_dedup.Dedup(crowd=crowd, shard=300, part=200))


# n-gram join


def test_join_matches_all_pairs(documents, odd_documents):
    for df in (documents, odd_documents):
        got = pairs(ngram_join.linked(df), "doc_id", "n_shingles", "component_id")
        assert order(got) == order(brute.join_components(pairs(df, "doc_id", "text")))


@pytest.mark.parametrize("crowd, block", [(16, 1500), (2, 7)])
def test_join_on_near_copies_and_common_passages(spark, crowd, block):
    rng = random.Random(crowd)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for i in range(40):
        own = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([3, 6, 12, 30, 90]))]
        for k in range(rng.randint(1, 5)):
            words = list(own)
            for _ in range(rng.randint(0, 1 + len(own) // 40)):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
            texts.append((len(texts), " ".join(passage + words if i % 2 else words)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = pairs(ngram_join.linked(df, ngram_join.Join(crowd=crowd, block=block)), "doc_id", "n_shingles", "component_id")
    assert order(got) == order(brute.join_components(texts))


def link_counts(rows):
    sets = [brute.shingle_set(t) for _, t in rows]
    out = []
    for i, (d, _) in enumerate(rows):
        linked = [bool(sets[i]) and 100 * len(sets[i] & s) >= 80 * len(sets[i] | s) for k, s in enumerate(sets) if k != i]
        out.append((d, sum(linked)))
    return order(out)


def test_links_are_counted(documents, odd_documents):
    for df in (documents, odd_documents):
        assert order(pairs(ngram_join.linked(df), "doc_id", "n_links")) == link_counts(pairs(df, "doc_id", "text"))


@pytest.mark.parametrize("crowd, block", [(16, 1500), (2, 7)])
def test_links_within_a_crowded_class_are_counted(spark, crowd, block):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(60):  # near copies, of which some pairs are linked and others only by way of a third
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
        texts += [(len(texts) + k, " ".join(words)) for k in range(rng.choice([1, 1, 3]))]
    texts += [(1000 + i, " ".join(base[:60] + [f"o{i}_{k}" for k in range(8)])) for i in range(40)]  # a common passage
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = ngram_join.linked(df, ngram_join.Join(crowd=crowd, block=block))
    assert order(pairs(got, "doc_id", "n_links")) == link_counts(texts)
    want = order(brute.join_components(texts))
    assert order(pairs(got, "doc_id", "n_shingles", "component_id")) == want


def test_linked_sets_share_a_key():
    """The pigeonhole holds on sets at the very edge of the threshold."""
    rng, j = np.random.default_rng(0), ngram_join.Join()
    for n in [4, 5, 8, 9, 10, 17, 40, 99, 250, 1000]:
        for _ in range(30):
            h = np.unique(rng.integers(0, 1 << 63, n * 2, dtype=np.int64)).astype(np.uint64)
            a = np.sort(rng.choice(h, n, replace=False))
            drop = rng.integers(0, n // 5 + 1)
            b = np.sort(np.concatenate([a[drop:], np.setdiff1d(h, a)[: rng.integers(0, n // 10 + 1)]]))
            if ngram_join.overlap_links(a, b, j):
                shared = np.intersect1d(ngram_join.keys_of(a, j), ngram_join.keys_of(b, j)).size
                assert shared >= max(ngram_join.needed(a, j), ngram_join.needed(b, j))


# mixing


def test_targets_are_water_filling(documents, odd_documents):
    for df in (documents, odd_documents):
        rows = mixing.mixed(df).collect()
        size = defaultdict(int)
        for d, t, s in pairs(df, "doc_id", "text", "source"):
            size[s] += len(brute.WORD.findall(t or ""))
        names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
        want = dict(zip(names, brute.water_filling([size[s] for s in names], [3, 1, 2], 1.5, 2.0)))
        assert len(rows) == df.count()
        taken, largest = defaultdict(int), defaultdict(int)
        for r in rows:
            assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-6)
            assert r["source_size"] == size[r["source"]] and r["taken"] <= 2 * r["size"]
            taken[r["source"]] += r["taken"]
            largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert all(abs(taken[s] - want[s]) <= 2 * largest[s] for s in names)


def test_mix_does_not_depend_on_partitions(documents):
    cols = ("doc_id", "taken")
    assert order(pairs(mixing.mixed(documents, block=20), *cols)) == order(pairs(mixing.mixed(documents.repartition(7), block=20), *cols))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(2)
    p, size = rng.random(500), rng.integers(1, 900, 500)
    q = mixing.flight(p, size, rng)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert math.isclose(p.sum(), q.sum(), rel_tol=1e-9) and math.isclose((p * size).sum(), (q * size).sum(), rel_tol=1e-9)


# packing


def test_bins_hold_their_limits(documents, odd_documents):
    for df in (documents, odd_documents):
        rows = packing.packed(df, capacity=256, group=50).collect()
        bins, whole = defaultdict(list), defaultdict(int)
        for r in rows:
            bins[r["bin_group"], r["bin"]].append(r)
            whole[r["doc_id"]] += r["size"]
        words = defaultdict(int)
        text = {}
        for d, t in pairs(df, "doc_id", "text"):
            words[d] += len(brute.WORD.findall(t or ""))
            text[d] = brute.lower(t)
        assert {d: n for d, n in words.items() if n} == dict(whole)
        for own in bins.values():
            assert sum(r["size"] for r in own) == own[0]["used"] <= 256
            assert max(Counter(text[r["doc_id"]] for r in own).values()) == 1
            assert max(Counter(r["source"] for r in own).values()) <= 2


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 3), st.integers(0, 5)), max_size=40))
def test_best_fit_takes_the_tightest_compatible_bin(items):
    items.sort(key=lambda x: -x[0])
    got = packing.best_fit([s for s, _, _ in items], [1 << s for _, s, _ in items], [1 << c for _, _, c in items], 30)
    bins = []
    for size, source, cluster in items:
        fits = [
            (30 - sum(x[0] for x in b), i)
            for i, b in enumerate(bins)
            if size < 30
            and size <= 30 - sum(x[0] for x in b)
            and cluster not in {x[2] for x in b}
            and sum(x[1] == source for x in b) < 2
        ]
        if fits:
            bins[min(fits)[1]].append((size, source, cluster))
        else:
            bins.append([(size, source, cluster)])
    assert sorted(Counter(got).values()) == sorted(len(b) for b in bins)


def test_other_clusters_and_sources_do_not_conflict(spark):
    rows = [(i, f"word{i} is text", f"s{i // 2}" if i > 1 else None) for i in range(300)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 300 and {(r["bin"], r["used"]) for r in got} == {(0, 900)}
    rows = [(i, f"word{i // 2} is text", f"s{i // 4}") for i in range(400)]  # pairs of copies, four of a source
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(Counter(r["bin"] for r in got).values()) == [200, 200]


# language model


def test_scores_match_dictionaries(spark):
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice(["ab", "aé", "b", "Abc", "ca"]) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    texts += [(40, None), (41, ""), (42, "zzz unseen ü"), (43, texts[3][1]), (None, "ab ab")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    training = fold(F.col("doc_id"), 7) != 2
    learned = pairs(df.where(training), "text")
    words = Counter(w for (t,) in learned for w in brute.WORD.findall(brute.lower(t)))
    n, v = sum(words.values()) + len(learned), len(words) + 1
    m = ppm.Ppm(order=3, part=300, block=200)
    text = dict(texts)
    rows = ppm.scored(df, training, m).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = brute.WORD.findall(brute.lower(text[r["doc_id"]]))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own) + 1, sum(w in words for w in own) + 1, n)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own) + math.log10((len(learned) + 1) / (n + v + 1))
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert math.isclose(r["score"], brute.ppm_log10([t for (t,) in learned], text[r["doc_id"]], 3), rel_tol=1e-9)


def test_scoring_odd_tables(odd_documents, no_documents):
    rows = ppm.scored(odd_documents, fold(F.col("doc_id"), 7) != 2).collect()
    assert len(rows) == odd_documents.count() and all(r["score"] < 0 for r in rows)
    none = ppm.scored(odd_documents.where("text is not null").limit(3), F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in none)
    assert ppm.scored(no_documents, F.lit(True)).count() == 0


# language


def test_held_out_accuracy(spark):
    docs = read(spark, SMALL, "documents")
    found = queries.op4_language_id(spark, SMALL).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.9


def test_language_of_odd_texts(odd_documents, no_documents):
    s = language_id.Settings(steps=20)
    rows = language_id.identified(odd_documents, F.lit(True), s).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "fr", "de") and 0 < r["score"] <= 1
    assert language_id.identified(no_documents, F.lit(True), s).count() == 0
    assert {r["lang_pred"] for r in language_id.identified(odd_documents, F.lit(False), s).collect()} == {"und"}


def test_gradients_agree_with_differences():
    s = language_id.Settings(window=12, embed=3, filters=4, widths=(2, 3))
    rng = np.random.default_rng(0)
    p = [rng.normal(0, 0.5, (256, 3))]
    for w in s.widths:
        p += [rng.normal(0, 0.5, (w * 3, 4)), rng.normal(0, 0.5, 4)]
    p += [rng.normal(0, 0.5, (8, 3)), np.zeros(3)]
    x, y = rng.integers(97, 110, (5, 12)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss(q):
        net = language_id.Network(["a", "b", "c"], q[0], [q[1], q[3]], [q[2], q[4]], q[5], q[6])
        z = language_id.Scorer(net, s).logits(x)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(5), y]).mean())

    grads = language_id._gradients(p, x, y, s)
    for i in range(len(p)):
        for _ in range(5):
            at = (int(rng.choice(np.unique(x))), int(rng.integers(3))) if i == 0 else tuple(int(rng.integers(n)) for n in p[i].shape)
            q = [a.copy() for a in p]
            q[i][at] += 1e-3
            up = loss(q)
            q[i][at] -= 2e-3
            assert abs((up - loss(q)) / 2e-3 - grads[i][at]) < 5e-3


# nearest neighbours


def truth(ids, x, query, k):
    score = nearest.cosine(np.broadcast_to(x[query], x.shape), x)
    return sorted((-s, int(i)) for s, i in zip(score, ids) if i != ids[query])[:k]


def test_recall_against_all_pairs(spark):
    df = read(spark, SMALL, "embeddings")
    rows = df.collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows])
    got = defaultdict(dict)
    for r in nearest.nearest(df, F.col("vec_id") % 50 == 0, c=nearest.Curves(least=10)).collect():
        got[r["query_id"]][r["vec_id"]] = r["score"]
    hit = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        want = truth(ids, x, q, 5)
        total += len(want)
        hit += sum(i in got[int(ids[q])] for _, i in want)
        assert all(math.isclose(s, got[int(ids[q])][i], rel_tol=1e-12) for s, i in [(-s, i) for s, i in want] if i in got[int(ids[q])])
    assert hit / total >= 0.9


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(0, 40)] + [(50, [1.0, 2.0, 0.5]), (50, [1.0, 2.0, 0.5]), (60, [0.0, 0.0, 0.0])]
    rows += [(61, None), (62, [1.0, None, 2.0]), (63, [float("nan"), 1.0, 1.0]), (64, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(100, [2.0, 4.0, 1.0]), (65, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = nearest.nearest(df, F.col("vec_id") % 50 == 0).collect()
    assert {r["query_id"] for r in got} == {0, 50, 100}
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 0] == [1, 2, 3, 4, 5]
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 50] == [0, 1, 2, 3, 4]
    assert nearest.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert nearest.nearest(df.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


# fingerprints


def weighted(text):
    words = brute.WORD.findall(text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [tuple(words)] if words else []
    return {g: 1 + int(math.log2(n)) for g, n in Counter(grams).items()}


def generalised(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / max(1, sum(max(a.get(k, 0), b.get(k, 0)) for k in keys))


def test_fingerprints_estimate_generalised_jaccard(documents, odd_documents):
    for df in (documents, odd_documents):
        rows = sorted(pairs(df, "doc_id", "text"), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        want = []
        for i, (d, t) in enumerate(rows):
            t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
            quarter = len(t) // 4
            edited = t[: len(t) - quarter] + after[:quarter]
            want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), t, edited))
        got = fingerprint.fingerprinted(df).collect()
        assert order([(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got]) == order([w[:3] for w in want])
        near = {(r["doc_id"], r["edited_sha256"]): r for r in got}
        error = [near[w[0], w[2]]["near_edited"] - generalised(weighted(w[3]), weighted(w[4])) for w in want if len(w[3]) > 1500]
        assert len(error) < 10 or (abs(np.mean(error)) < 0.03 and np.std(error) < 0.08)
        prints = defaultdict(set)
        for r, w in ((near[w[0], w[2]], w) for w in want):
            prints[w[3]].add(r["fingerprint"])
        assert all(len(p) == 1 for p in prints.values())


def test_ranges_of_ids_do_not_change_the_next_document(documents):
    cols = ("doc_id", "edited_sha256", "near_edited", "near_next")
    one, many = fingerprint.fingerprinted(documents), fingerprint.fingerprinted(documents, fingerprint.Sketch(block=13))
    assert order(pairs(one, *cols)) == order(pairs(many, *cols))


def test_native_plan(documents):
    plan = fingerprint.fingerprinted(documents)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_empty_tables(no_documents):
    assert fingerprint.fingerprinted(no_documents).count() == 0
    assert substring_dedup.removed(no_documents).count() == 0
    assert ngram_join.linked(no_documents).count() == 0
    assert mixing.mixed(no_documents).count() == 0
    assert packing.packed(no_documents).count() == 0


def test_words_split_where_the_pattern_splits(monkeypatch):
    text = "a\x0bb\x0cc\x1cd\x85e\u00a0f\u2003g \tH a\r\n"
    words = brute.WORD.findall(brute.lower(text))
    raw = common.as_bytes(text).translate(common.LOWER)
    assert [w.decode() for w in raw.split()] == words
    assert len(set(common.word_hashes(raw).tolist())) == len(set(words))
    rng = random.Random(0)
    raw = b" ".join(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(400)) + b"  "
    whole = common.word_hashes(raw)
    by_word = [common.word_hashes(w)[0] for w in raw.split()]
    assert whole.tolist() == by_word and len(set(by_word)) == len(set(raw.split()))
    monkeypatch.setattr(common, "_SEGMENT", 16)
    assert common.word_hashes(raw).tolist() == by_word


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=4, max_size=40), st.integers(1, 4))
def test_smallest_in_windows(values, width):
    got = substring_dedup.smallest_in_windows(np.array(values, dtype=np.uint64) << np.uint64(32), width)
    assert got.tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(len(values) - width + 1)]


# hashes


def test_words_of_two_letters_in_thue_morse_order():
    """Two such words have one polynomial hash modulo 2**64, whatever its base; here they are as different as others."""
    signs = [bin(i).count("1") % 2 for i in range(2048)]
    for n in (8, 64, 65, 256, 1024, 2048):
        a, b = ("".join(x[s] for s in signs[:n]) for x in ("ab", "ba"))
        assert len(set(common.word_hashes(f"{a} {b} {a}".encode()).tolist())) == 2


def thue_morse_documents(spark):
    signs = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = ("".join(x[s] for s in signs) for x in ("ab", "ba"))
    words = [f"w{i}" for i in range(34)]
    rows = [(1, " ".join([*words[:17], a, *words[17:]])), (2, " ".join([*words[:17], b, *words[17:]])), (3, a), (4, b)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_equal_hashes_of_long_words_do_not_make_texts_equal(spark):
    rows, df = thue_morse_documents(spark)
    assert {r["n_removed"] for r in substring_dedup.removed(df).collect()} == {0}
    got = pairs(ngram_join.linked(df), "doc_id", "n_shingles", "component_id")
    assert order(got) == order(brute.join_components(rows))
    scored = ppm.scored(df, F.col("doc_id") == 3).collect()
    assert {r["doc_id"]: r["n_known"] for r in scored} == {1: 2, 2: 1, 3: 2, 4: 1}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=90), max_size=30))
def test_word_hashes_are_equal_for_equal_words_only(words):
    raw = (" \t".join(words) + " ").encode()
    assert len(common.word_hashes(raw)) == len(words)
    assert len(set(common.word_hashes(raw).tolist())) == len(set(words))


def test_ties_of_scaled_vectors_go_to_the_smaller_id(spark):
    """Powers of two times one vector have one cosine to the last bit."""
    rows = [(i, [2.0**i, -(2.0**i) * 3, 2.0**i * 0.5]) for i in range(60)]
    got = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    found = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect())
    assert found == [(0, r, r) for r in range(1, 6)] + [(50, r, r - 1) for r in range(1, 6)]
