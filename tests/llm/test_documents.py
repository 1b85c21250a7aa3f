"""Operators over documents against brute force, on a corpus with nulls, ties, copies and long texts."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from eavflow.llm import exact_dedup, katz, language_id, line_dedup, mixing, packing, quality, simhash
from eavflow.llm.queries import tokenizer_path
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return WORD.findall(t or "")


def bag(df, *cols):
    return collections.Counter(tuple(r[c] for c in cols) for r in df.collect())


# -- 1 mixing --------------------------------------------------------------------

def fill(sizes, weights):
    target, free = {}, set(sizes)
    while free:
        level = (sum(sizes.values()) - sum(target.values())) / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * weights[s] for s in free}
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return target


def test_mixing(docs, rows, no_docs):
    out = mixing.mix(docs, mixing.words(F.col("text")))
    got = out.collect()
    assert len(got) == len(rows) and "odd `name.with dots" in out.columns and out.columns.count("size") == 1
    sizes = collections.Counter()
    for d, t, l, s, n in rows:
        sizes[s] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = fill(dict(sizes), {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)})
    assert math.isclose(sum(goal.values()), sum(sizes.values()))
    most = collections.Counter()
    for r in got:
        assert r["size"] == len(words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], goal[r["source"]]) and 0 <= r["copies"] <= 3
        assert r["taken"] == r["copies"] * r["size"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    for s in sizes:
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - goal[s]) <= 3 * most[s]
    again = mixing.mix(docs.repartition(5), mixing.words(F.col("text")))
    assert bag(out, "doc_id", "text", "copies") == bag(again, "doc_id", "text", "copies")
    emitted = mixing.emit(out, ["doc_id", "text"]).count()
    assert emitted == sum(r["copies"] for r in got)
    assert mixing.mix(no_docs, mixing.words(F.col("text"))).count() == 0


@pytest.mark.parametrize("sizes", [[5, 100, 1000, 0], [1, 1, 1], [10**6, 1, 2, 3, 4, 5]])
def test_targets_match_step_by_step_filling(spark, sizes):
    by = {f"s{i}": x for i, x in enumerate(sizes)}
    df = spark.createDataFrame(list(by.items()), "_e_src string, _e_words long")
    got = {r["_e_src"]: r["_e_target"] for r in mixing.targets(df).collect()}
    want = fill(by, {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(by))})
    assert all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in by)


# -- 2 exact dedup -----------------------------------------------------------------

def test_exact_dedup(docs, rows, no_docs):
    def run(df):
        df = df.withColumn("norm", exact_dedup.normalised(F.col("text")))
        return exact_dedup.exact_dedup(df, "norm", F.coalesce(F.length("text"), F.lit(0)))
    got = run(docs).collect()
    assert len(got) == len(rows)
    groups = collections.defaultdict(list)
    for d, t, *_ in rows:
        groups["".join(words(t))].append((-len(t or ""), d is None, d))
    for r in got:
        g = groups["".join(words(r["text"]))]
        assert r["group_size"] == len(g) and r["keep_id"] == min(g, key=lambda x: (x[0], x[1], x[2] or 0))[2]
    assert sum(r["kept"] for r in got) == len(groups)
    assert run(no_docs).count() == 0


def test_exact_dedup_splits_a_hot_group_by_later_digits(spark):
    stem = "same " * 400
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.concat(
        F.lit(stem), F.when(F.col("id") % 3 == 0, "end").otherwise(F.col("id").cast("string"))).alias("norm"))
    got = exact_dedup.exact_dedup(df, "norm", F.lit(0)).collect()
    assert {r["group_size"] for r in got if r["doc_id"] % 3 == 0} == {300}
    assert {r["group_size"] for r in got if r["doc_id"] % 3} == {1}
    assert {r["keep_id"] for r in got if r["doc_id"] % 3 == 0} == {0}


# -- 3 Katz ------------------------------------------------------------------------

def katz_by_hand(texts, train):
    toks = [[w.translate(LOWER) for w in words(t)] + ["</s>"] for t in texts]
    c1, c2, ch = collections.Counter(), collections.Counter(), collections.Counter()
    for w, t in zip(toks, train):
        if t:
            before = ["<s>", *w[:-1]]
            c1.update(w)
            c2.update(zip(before, w))
            ch.update(before)
    total = sum(c1.values())
    discounts = []
    for c in (c1, c2):
        n = collections.Counter(v for v in c.values() if v <= katz.K + 1)
        discounts.append(katz.good_turing([n[r] for r in range(katz.K + 2)]))
    d1, d2 = [lambda r, d=d: float(d(np.array([r]))[0]) for d in discounts]
    left = 1 - sum(d1(v) for v in c1.values()) / total if total else 1.0
    p1 = lambda w: d1(c1[w]) / total if c1[w] else left
    after = collections.defaultdict(list)
    for (h, w), c in c2.items():
        after[h].append((w, c))
    alpha = {h: sum(c - d2(c) for _, c in f) / ch[h] / (1 - sum(p1(w) for w, _ in f)) for h, f in after.items()}
    p = lambda h, w: d2(c2[h, w]) / ch[h] if c2[h, w] else alpha.get(h, 1.0) * p1(w)
    return toks, c1, total, p, alpha, left


def test_katz(docs, rows, no_docs):
    got = katz.score(docs, language_id.held_out(F.col("doc_id"), 7, 2) == F.lit(False)).collect()
    assert len(got) == len(rows)
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    # the score does not depend on the row, only on its text
    toks, c1, total, p, alpha, left = katz_by_hand([r[1] for r in rows], [not held(r[0]) for r in rows])
    for h in ["<s>", *list(alpha)[:20]]:
        assert math.isclose(sum(p(h, w) for w in c1) + alpha[h] * left, 1.0, rel_tol=1e-9)
    want = {}
    for (d, t, *_), w in zip(rows, toks):
        want[(d, t)] = (len(w), sum(x in c1 for x in w), sum(math.log10((c1[x] + 1) / (total + len(c1) + 1)) for x in w),
                        sum(math.log10(p(h, x)) for h, x in zip(["<s>", *w], w)))
    for r in got:
        n, known, base, s = want[(r["doc_id"], r["text"])] if "text" in r else want[next(k for k in want if k[0] == r["doc_id"])]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total) or r["doc_id"] is None
        if r["doc_id"] is not None:
            assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], s, rel_tol=1e-9)
    assert katz.score(no_docs, F.lit(True)).count() == 0
    untrained = katz.score(docs.limit(5), F.lit(False)).collect()
    assert {r["score"] for r in untrained} == {0.0}


def test_katz_packed_columns_round_trip():
    a = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (katz.unpack_sorted(katz.pack_sorted(a)) == a).all()
    assert len(katz.unpack(katz.pack(a[:0]))) == 0


# -- 4 packing -----------------------------------------------------------------------

def test_packing(docs, rows, no_docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    out = packing.pieces(docs, tokenizer_path(), length=64)
    got = out.collect()
    back = collections.defaultdict(dict)
    want = collections.Counter()
    for d, t, *_ in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), 64)):
            want[(d, k, s, len(ids[s:s + 64]), np.array(ids[s:s + 64], "<u4").tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in got) == want
    packed = packing.pack(out.select("doc_id", "piece", "length", F.lit(1).alias("offset")), capacity=64).collect()
    assert len(packed) == len(got)
    for r in packed:
        back[r["sequence_id"]][r["offset"]] = r["length"]
    for seq in back.values():
        at = 0
        for o in sorted(seq):
            assert o == at
            at += seq[o]
        assert at <= 64
    assert sum(len(s) for s in back.values()) == len(got)
    assert len(back) <= 1.02 * -(-sum(r["length"] for r in got) // 64) + 1
    assert packing.pack(packing.pieces(no_docs, tokenizer_path())).count() == 0


def test_packing_tree_merges_many_chunks(spark):
    df = spark.range(0, 6000, 1, 20).select("id", (F.pmod(F.xxhash64("id"), F.lit(90)) + 1).alias("length"))
    got = packing.pack(df, capacity=100).collect()
    fill_ = collections.Counter()
    for r in got:
        fill_[r["sequence_id"]] += r["length"]
    assert len(got) == 6000 and max(fill_.values()) <= 100
    # near what one best-fit over everything takes, though a task saw 300 pieces
    assert len(fill_) <= 1.05 * len(packing.best_fit(np.array([r["length"] for r in got]), 100)[2])
    for r in got:
        assert r["offset"] + r["length"] <= 100


def test_best_fit_is_best_fit():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 100, 500)
    of, off, fill_ = packing.best_fit(sizes, 100)
    assert max(fill_) <= 100 and (np.bincount(of, sizes) == fill_).all()
    half = [f for f in fill_ if f * 2 <= 100]
    assert len(half) <= 1
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), 100)


# -- 5 quality -------------------------------------------------------------------------

def test_quality(spark, docs, rows, no_docs):
    labelled = [(d, int(d % 3 != 0), 0) for d, *_ in rows if d is not None and d < 120]
    junk = {d for d, q, _ in labelled if q == 0}
    labels = spark.createDataFrame(labelled + [(None, 1, 0), (5, None, 0), (1, 0, 0), (1, 1, 0), (1, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    shout = docs.withColumn("text", F.when(F.col("doc_id").isin(*junk), F.concat(F.upper("text"), F.lit(" ### $$$"))).otherwise(F.col("text")))
    model = quality.fit(shout, labels)
    out = quality.classify(shout, model)
    got = out.collect()
    assert len(got) == len(rows) and out.columns.count("score") == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    right = [r["predicted"] == int(r["doc_id"] not in junk) for r in got if r["doc_id"] is not None and r["doc_id"] < 120]
    assert sum(right) >= 0.97 * len(right)
    # the score is the logistic of the difference of the two Gaussian log densities
    x = quality.statistics(__import__("pyarrow").array([r["text"] for r in got]))
    dens = []
    for prior, mean, inv, logdet in model.factors:
        cov = np.linalg.inv(inv.T @ inv)
        diff = x - mean
        dens.append(prior - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff) - 0.5 * np.linalg.slogdet(cov)[1])
    want = 1 / (1 + np.exp(np.clip(dens[0] - dens[1], -700, 700)))
    assert np.allclose([r["score"] for r in got], want, atol=1e-6)
    one = labels.where("quality = 1")
    assert quality.fit(shout, one).factors is None and quality.fit(shout, labels.limit(0)).rate == 0.5
    assert quality.classify(no_docs, model).count() == 0


# -- 6 language ------------------------------------------------------------------------

def test_language(spark, docs, rows, no_docs):
    made = {"en": "the quick brown fox and the lazy dog ", "de": "der schnelle fuchs und die faule hündin ", "fr": "le renard rapide et la chienne "}
    train = spark.createDataFrame([(t * 5, l) for l, t in made.items()] + [(None, "en"), ("x", None), ("", "fr"), ("5 6", "es")],
                                  "text string, lang string")
    model = language_id.fit(train)
    assert model.langs == ["de", "en", "fr"]
    out = language_id.predict(docs, model)
    got = out.collect()
    assert len(got) == len(rows) and [c.lower() for c in out.columns].count("lang_pred") == 1
    for r in got:
        bare = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == bare and 0 <= r["score"] <= 1
    # sparse scoring against sums gram by gram
    for lang, t in made.items():
        name, score = model.predict([t])
        assert name == [lang]
        cell, n = language_id.grams([t], len(model.matrix))
        total = model.matrix[cell].sum(axis=0)
        assert math.isclose(score[0], np.exp(total - total.max()).max() / np.exp(total - total.max()).sum()) and n[0] == len(cell)
    assert language_id.predict(docs, language_id.fit(train.limit(0))).where("lang_pred <> 'und'").count() == 0
    assert language_id.predict(no_docs, model).count() == 0


def bayes_by_hand(rows, cells):
    """(text, lang) rows -> log probabilities by language and cell, one n-gram at a time."""
    def cells_of(text):
        t = "".join(c if ord(c) > 127 or c.isalpha() else " " for c in text.lower())
        for n in (1, 2, 3):
            for i in range(len(t) - n + 1):
                h = 0
                for c in t[i:i + n]:
                    h = (h * 0x100000001B3 + ord(c)) % 2 ** 64
                yield (h + n) * 0x9E3779B97F4A7C15 % 2 ** 64 * cells >> 64
    count = {}
    for t, l in rows:
        if t and l and any(c.isalpha() for c in t):
            count.setdefault(l, collections.Counter()).update(cells_of(t))
    logs = {l: [math.log((n[c] + 0.1) / (sum(n.values()) + 0.1 * cells)) for c in range(cells)] for l, n in count.items()}
    return logs, lambda t: {l: sum(p[c] for c in cells_of(t)) for l, p in logs.items()}


def test_language_training_and_scores_by_hand(spark, rows, monkeypatch):
    taught = [(t, l) for _, t, l, *_ in rows if t is None or len(t) < 900]
    for piece, matrix in ((language_id.PIECE, language_id.MATRIX), (7, 256)):     # one piece and block; many pieces, a block a language
        monkeypatch.setattr(language_id, "MATRIX", matrix)
        model = language_id.fit(spark.createDataFrame(taught, "text string, lang string"), cells=256)
        monkeypatch.setattr(language_id, "PIECE", piece)
        logs, sums = bayes_by_hand(taught, 256)
        assert model.langs == sorted(logs) and len(model.blocks) == (1 if piece > 10 else len(logs))
        assert np.allclose(model.matrix, np.array([logs[x] for x in model.langs]).T, rtol=1e-12)
        texts = [t for t, _ in taught[:40] if t and any(c.isalpha() for c in t)]
        for t, name, score in zip(texts, *model.predict(texts)):
            total = sums(t)
            best = max(sorted(total), key=total.get)
            assert name == best
            assert math.isclose(score, 1 / sum(math.exp(v - total[best]) for v in total.values()), rel_tol=1e-6)


def test_pieces_of_a_text_have_its_grams(monkeypatch):
    texts = ["Ünï cödé xyz", "", "a", "ab", "abc", "ΑΣ ΟΔΟΣ 漢字 and more of it", "x" * 70]
    whole = [sorted(language_id.grams([t], 1 << 12)[0]) for t in texts]
    for piece in (1, 2, 3, 8):
        monkeypatch.setattr(language_id, "PIECE", piece)
        got = collections.defaultdict(list)
        for at, parts, starts in language_id._runs(texts):
            assert sum(map(len, parts)) <= piece + 2 * len(parts)
            cell, n = language_id.grams(parts, 1 << 12, starts)
            for i, p in zip(at, np.split(cell, np.cumsum(n)[:-1])):
                got[i] += p.tolist()
        assert [sorted(got[i]) for i in range(len(texts))] == whole


def test_grams_of_a_batch_are_those_of_each_text():
    texts = ["ab", "", "a", "Ünï cödé", "漢字 xyz!"]
    cell, n = language_id.grams(texts, 1 << 12)
    parts = np.split(cell, np.cumsum(n)[:-1])
    assert all((p == language_id.grams([t], 1 << 12)[0]).all() for p, t in zip(parts, texts))
    assert n.tolist() == [3, 0, 1, 3 * len("Ünï cödé") - 3, 3 * len("漢字 xyz!") - 3]


# -- 7 line dedup ----------------------------------------------------------------------

def lines_by_hand(rows):
    """Rows (id, text) in the order (id, row); -> text after dedup by exact all-pairs similarity."""
    lines = {}
    for i, (d, t) in enumerate(rows):
        for k, s in line_dedup.lines_of(t):
            lines.setdefault(s, []).append((d is None, d or 0, i, k))
    keys = list(lines)
    n = line_dedup.SHINGLE
    sets = [{k.lower()[i:i + n] for i in range(max(1, len(k.lower()) - n + 1))} for k in keys]
    up = list(range(len(keys)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(keys)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                up[root(i)] = root(j)
    first = {}
    for i, k in enumerate(keys):
        first[root(i)] = min([first.get(root(i), (2,)), *lines[k]])
    keep = {x for x in first.values()}
    out = []
    for i, (d, t) in enumerate(rows):
        own = {k for k, _ in line_dedup.lines_of(t)}
        out.append(None if t is None else "\n".join(
            x for k, x in enumerate(t.split("\n")) if k not in own or (d is None, d or 0, i, k) in keep))
    return out


def test_line_dedup(spark, docs, rows, no_docs):
    out = line_dedup.line_dedup(docs)
    got = out.collect()
    assert len(got) == len(rows) and [c for c in out.columns if c == "text"] == ["text"] and "odd `name.with dots" in out.columns
    # repeated ids and rows may keep their line in any of them, so texts are compared as a whole
    want = collections.Counter((d, t) for (d, *_), t in zip(rows, lines_by_hand([(r[0], r[1]) for r in rows])))
    assert collections.Counter((r["doc_id"], r["text"]) for r in got) == want
    shared = "A line that many documents share, word for word."
    assert sum(shared in (r["text"] or "") for r in got) == 1
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[406]["removed"] == [0] and by[405]["removed"] == [] and by[300]["text"] is None
    assert line_dedup.line_dedup(no_docs).count() == 0


def test_line_dedup_finds_chains_and_large_groups(spark, monkeypatch):
    """Lines in a chain: each is like the next but not like the ones further on; tiles of a few lines."""
    monkeypatch.setattr(line_dedup, "TILE", 4)
    base = list("the quick brown fox jumps over the lazy dog while seven wizards brew a potion of old oak leaves")
    text, rows = list(base), []
    for k in range(30):
        text[3 * k % len(text)] = chr(0x4E00 + k)
        rows.append((k, "".join(text)))
    want = lines_by_hand(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(df).collect()}
    assert [got[k] for k in range(30)] == want


def test_line_bands_and_sets_against_plain_sets():
    """Of random pairs of similarity 0.8 to 0.9 nearly all share a band; similarities agree with sets of strings."""
    rng, n = random.Random(3), line_dedup.SHINGLE
    letters = "abcdefghijklmnopqrstuvwxyz    éß漢"

    def grams(x):
        x = x.lower()
        return {x[i:i + n] for i in range(max(1, len(x) - n + 1))}

    pairs = []
    while len(pairs) < 2000:
        a = "".join(rng.choices(letters, k=rng.randint(60, 400)))
        b = list(a)
        for _ in range(rng.randint(1, 4)):
            b[rng.randrange(len(b))] = rng.choice(letters)
        b = "".join(b)
        s = len(grams(a) & grams(b)) / len(grams(a) | grams(b))
        if 0.8 <= s <= 0.9:
            pairs.append((a, b))
    keys = line_dedup.bands([x for p in pairs for x in p])
    assert (keys[::2] == keys[1::2]).any(axis=1).mean() >= 0.99
    some = [x for p in pairs[:60] for x in p] + ["short", "SHORT", "x", "y" * 4000, "y" * 5000]
    sets = line_dedup.Sets(some)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(some)), np.arange(len(some))))
    want = [len(grams(some[x]) & grams(some[y])) >= 0.8 * len(grams(some[x]) | grams(some[y])) for x, y in zip(i, j)]
    assert sets.pairs(i, j).tolist() == want


# -- 9 SimHash ---------------------------------------------------------------------------

def print_by_hand(text, n=4):
    w = [x.translate(LOWER) for x in words(text)]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, rows, no_docs):
    out = simhash.near_dedup(docs)
    got = out.collect()
    assert len(got) == len(rows) and out.columns.count("kept") == 1
    prints = {t: print_by_hand(t) for _, t, *_ in rows}
    ids = collections.defaultdict(list)
    for d, t, *_ in rows:
        ids[prints[t]].append(d)
    nodes = list(ids)
    comp = {x: x for x in nodes}
    for _ in nodes:
        new = {x: min([comp[x]] + [comp[y] for y in nodes if (x ^ y).bit_count() <= 4]) for x in nodes}
        if new == comp:
            break
        comp = new
    least = {}
    for x in nodes:
        for d in ids[x]:
            if d is not None:
                least[comp[x]] = min(least.get(comp[x], d), d)
    for r in got:
        x = prints[r["text"]]
        assert r["fingerprint"] == f"{x:016x}" and r["component_id"] == least.get(comp[x])
    kept = collections.Counter(comp[prints[r["text"]]] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(set(comp.values()))
    assert simhash.near_dedup(no_docs).count() == 0


def test_simhash_tiles_lose_no_pair(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    x = [centres]
    for _ in range(60):
        flip = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (3, 40)).astype(np.uint64), axis=0)
        x.append(x[-1] ^ flip if rng.random() < 0.5 else centres ^ flip)
    x = np.unique(np.concatenate(x))
    order = np.lexsort((x, *simhash._quarters(x).T[::-1]))
    x = x[order]
    near = np.bitwise_count(x[:, None] ^ x[None]) <= 4
    want = np.arange(len(x))
    while True:
        new = np.array([want[near[i]].min() for i in range(len(x))])
        if (new == want).all():
            break
        want = new
    for tile in (8, 64, 512):
        old, simhash.TILE = simhash.TILE, tile
        try:
            assert (simhash.close(x, x, 4, True).label == want).all()
            a, b = x[::2], x[1::2]
            both = np.concatenate([a, b])
            n2 = np.bitwise_count(a[:, None] ^ b[None]) <= 4
            forest = simhash.close(a, b, 4, False)
            for i, j in zip(*np.nonzero(n2)):
                assert forest.label[i] == forest.label[len(a) + j]
            assert len(forest.edges) <= len(both) - 1
        finally:
            simhash.TILE = old


def test_fingerprint_of_a_long_text():
    t = "Aa bB " * 20_000
    assert simhash.fingerprint(t) == print_by_hand(t)


def test_sha_of_the_normalised_text(spark):
    df = spark.createDataFrame([("a b\tc\n\x0b\x0c\rd\x1c\u00a0e",), (None,)], "t string")
    got = [r[0] for r in df.select(F.sha2(exact_dedup.normalised(F.col("t")).cast("binary"), 256)).collect()]
    assert got == [hashlib.sha256("abcd\x1c\u00a0e".encode()).hexdigest(), hashlib.sha256(b"").hexdigest()]


def test_line_candidates_are_narrow():
    sets = line_dedup.Sets(["abcdefghij", "abcdefghijk"])
    assert sets.slots.dtype.itemsize == 2 and sets.slots.sum(axis=1).tolist() == [3, 4]
    assert line_dedup.BAND_BITS <= 40


def test_band_keys_meet_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HEADS", 60)        # a few lines a row, many buckets
    r, n = random.Random(8), line_dedup.BANDS
    top = (1 << line_dedup.BAND_BITS) - 1
    rows = [(r.randrange(-1 << 63, 1 << 63), [7 if j == 0 else top if j == 1 else r.randrange(40) << 33 if j < 5 else r.getrandbits(63) for j in range(n)])
            for _ in range(200)]
    rows += [(rows[3][0], [11] * n), (rows[3][0] ^ 1, [11] * n), (5 << 32, [12] * n), (6 << 32, [12] * n)]      # halves of hashes tell lines apart
    lines = spark.createDataFrame(rows, "k long, bands array<long>").repartition(3)
    seen = {}
    for k, bands in rows:
        for b in bands:
            seen.setdefault(b & top, set()).add(k >> 32)
    heads = line_dedup._heads(lines)
    assert sorted(x["b"] for x in heads.collect()) == sorted(b for b, k in seen.items() if len(k) > 1)
    assert line_dedup._heads(lines.where("k is null")).count() == 0
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan       # no row per line and band is shuffled


def test_lines_go_before_candidates_are_compared(spark, docs, monkeypatch):
    import glob
    from urllib.parse import urlparse
    left, compare = [], line_dedup._components

    def watched(lines, scratch):
        root = urlparse(lines._eav_path).path.rsplit("/", 2)[0]
        left.extend(glob.glob(f"{root}/*/t*/kind=*"))
        return compare(lines, scratch)
    monkeypatch.setattr(line_dedup, "_components", watched)
    assert line_dedup.line_dedup(docs).count()
    assert [x for x in left if x.endswith("kind=0")]
    # other tests' tables may lie there too: of each, what is still read has its lines' places
    assert {x.rsplit("/", 1)[0] for x in left if x.endswith("kind=1")} < {x.rsplit("/", 1)[0] for x in left if x.endswith("kind=0")}


def near_lines():
    """Families of lines that differ in a few letters, some several times, in texts of three lines."""
    r, out = random.Random(21), []
    for _ in range(12):
        base = [r.choice("abcdefghij klmno") for _ in range(r.randint(40, 160))]
        for _ in range(r.randint(1, 9)):
            x = list(base)
            for _ in range(r.randint(0, 4)):
                x[r.randrange(len(x))] = r.choice("pqrst")
            out += ["".join(x).strip() or "x"] * r.randint(1, 2)
    r.shuffle(out)
    return [(k, "\n".join(out[3 * k:3 * k + 3])) for k in range(len(out) // 3)]


@pytest.mark.parametrize("tile", [2, 5, 256])
def test_lines_of_small_and_of_large_groups(spark, monkeypatch, tile):
    monkeypatch.setattr(line_dedup, "TILE", tile)
    monkeypatch.setattr(line_dedup, "HEADS", 60)
    rows = near_lines()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(df).collect()}
    assert [got[k]["text"] for k, _ in rows] == lines_by_hand(rows)
    assert [got[k]["n_lines"] for k, _ in rows] == [len(line_dedup.lines_of(t)) for _, t in rows]


def test_full_bit_maps_add_no_lines(spark, monkeypatch):
    """As on large corpora: every slot is set, and still only lines that share a band with another are compared."""
    monkeypatch.setattr(line_dedup, "BITS", 6)
    monkeypatch.setattr(line_dedup, "_wide", lambda n: 6, raising=False)
    r = random.Random(5)
    rows = near_lines() + [(1000 + k, "".join(r.choices("abcdefghijklmnop ", k=90)) + "z") for k in range(30)] + [(2000, None), (2001, " \n\n\x0b x \n")]
    lines = sorted({x for _, t in rows for _, x in line_dedup.lines_of(t)})
    keys = line_dedup.bands(lines)
    often = collections.Counter(int(b) for k in keys for b in set(k.tolist()))
    want = {x for x, k in zip(lines, keys) if any(often[int(b)] > 1 for b in k)}
    seen, compare = [], line_dedup._components

    def watched(lines, scratch):
        seen.extend(r["line"] for r in lines.select("line").collect())
        return compare(lines, scratch)
    monkeypatch.setattr(line_dedup, "_components", watched)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(df).collect()}
    assert sorted(seen) == sorted(want) and len(want) < len(lines)
    assert [got[k]["text"] for k, _ in rows] == lines_by_hand(rows)
    assert [got[k]["n_lines"] for k, _ in rows][-2:] == [0, 1]


def test_lines_are_not_staged_before_they_are_candidates(spark, docs):
    cut = line_dedup._cut(docs.select(F.monotonically_increasing_id().alias("_e_row"), F.col("doc_id").alias("_e_id"), "text"))
    assert "string" not in dict(cut.dtypes).values()
