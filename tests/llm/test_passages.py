"""Repeated passages, collocations and hard negatives against brute force."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eavflow.llm import collocations, hard_negatives, packing, substring_dedup, words
from eavflow.llm.queries import tokenizer_path

SPACE = r"[\x20\x09-\x0D]+"


def thue_morse(n):
    """Two words over a, b of ``n`` letters, each the other's complement: polynomial hashes modulo 2**64 confuse them."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


# -- words --------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [512, 1024, 2048])
def test_words_of_alike_structure_are_told_apart(n):
    x, y = thue_morse(n)
    buf, offs = words.as_bytes(pa.array([f"{x} {y} {x}", y.upper()]))
    start, end, _ = words.spans(buf, offs)
    key = words.keys(buf, start, end).tolist()
    assert key[0] == key[2] != key[1] == key[3]
    code, found = words.coded(buf, start, end, lower=False)
    assert found.to_pylist() == [x.encode(), y.encode(), y.upper().encode()] and code.tolist() == [0, 1, 0, 2]


def test_packed_ids_are_the_tokenizers():
    from tokenizers import Tokenizer
    x, y = thue_morse(1024)
    text = f"{x} {y} {y} {x}"
    buf, offs = words.as_bytes(pa.array([text, y]))
    ids, n = packing.token_ids(buf, offs, tokenizer_path())
    t = Tokenizer.from_file(tokenizer_path())
    want = [t.encode(v, add_special_tokens=False).ids + [0] for v in (text, y)]
    assert ids.tolist() == want[0] + want[1] and n.tolist() == list(map(len, want))


def test_ids_of_words_cut_at_marks_are_the_tokenizers():
    from tokenizers import Tokenizer
    t, r = Tokenizer.from_file(tokenizer_path()), random.Random(3)
    signs = [*"aAbBhHsStT''.,;=<>|-_(\"0\x00\x7f\x1c  \t\nÄäß×÷é", "\u0301", "\u0331", "\u0338", "\u037e", "\u212a", "…", "’", "д", "漢",
             "'ll", "'RE", "H\u0331"]
    texts = ["".join(r.choices(signs, k=r.randint(0, 40))) for _ in range(3000)] + [None, "It's. (The) END; don't-stop"]
    special = ["a<|startoftext|>b", "A.<|ENDOFTEXT|>,b Foo.", "<|endoftext"]     # tokens of their own: nothing is cut near them
    for part in (texts, special):
        ids, n = packing.token_ids(*words.as_bytes(pa.array(part)), tokenizer_path())
        want = [t.encode(v or "", add_special_tokens=False).ids + [0] for v in part]
        assert ids.tolist() == sum(want, []) and n.tolist() == list(map(len, want))


def test_a_word_is_encoded_once_whatever_its_case_and_marks(monkeypatch):
    monkeypatch.setattr(packing, "_WORKER", {})
    texts = ["Wordish wordish, (WORDISH) \"wordish.\" Schön schön! schön-wordish"]
    packing.token_ids(*words.as_bytes(pa.array(texts)), tokenizer_path())
    known = packing._WORKER["young"]
    assert [w.decode() for w in known if any(c.isalpha() for c in w.decode())] == ["wordish", "schön"]


# -- 11 substring dedup --------------------------------------------------------------------

def without_repeats(rows, size=13):
    """(id, words, kept words) by comparing all windows."""
    first, cut = {}, []
    for i, t in rows:
        w = [x for x in re.split(SPACE, t or "") if x]
        cut.append((i, w))
        for k in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[k:k + size])
                first[key] = min(first.get(key, i), i)
    out = collections.Counter()
    for i, w in cut:
        gone = set()
        for k in range(len(w) - size + 1):
            lo = first.get(tuple(w[k:k + size]))
            if lo is not None and (i is None or lo < i):
                gone.update(range(k, k + size))
        out[i, len(w), tuple(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


def passage_rows():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(1, 3)))
    shared = [[word() for _ in range(n)] for n in (12, 13, 14, 40, 200)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(r.randint(0, 6)):
            w += [word() for _ in range(r.randint(0, 30))]
            p = r.choice(shared)
            a = r.randint(0, len(p) // 3)
            w += p[a:a + r.randint(5, len(p))]          # parts of passages, nested in each other
        rows.append((i * 3 % 157, (" " if i % 2 else "\n\t").join(w)))
    long = " ".join(word() for _ in range(6000))
    rows += [(500, long), (501, "x " + long), (502, long[: len(long) // 2]), (503, "a " * 300), (504, "a " * 40), (505, "a b " * 30),
             (506, "b a " * 30), (507, None), (508, ""), (509, " \n"), (None, long), (None, None), (500, "y y " + long[:900]),
             (510, "é ü 漢字 " * 20), (511, "é ü 漢字 " * 9)]
    x, y = thue_morse(512)
    rows += [(520, f"{x} " * 14), (521, f"{y} " * 14)]          # nothing in common
    rows += [(600 + i, " ".join(shared[4])) for i in range(60)]        # a hot passage
    return rows


def test_substring_dedup(spark, monkeypatch):
    rows = passage_rows()
    want = without_repeats(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    df = df.select("*", *[F.lit(7).alias(c) for c in ("n_words", "Removed", "block", "ids", "from_at", "id", "n")])
    for block, shard in ((1 << 21, 1 << 21), (3000, 400)):
        monkeypatch.setattr(substring_dedup, "BLOCK", block)
        monkeypatch.setattr(substring_dedup, "SHARD", shard)
        out = substring_dedup.substring_dedup(df)
        assert out.columns == ["doc_id", "text", "block", "ids", "from_at", "id", "n", "n_words", "n_removed", "removed"]
        got = out.collect()
        assert collections.Counter((r["doc_id"], r["n_words"], tuple(r["text"].split(" ") if r["text"] else ())) for r in got) == want
        texts = collections.defaultdict(list)
        for i, t in rows:
            texts[i].append([x for x in re.split(SPACE, t or "") if x])
        for r in got:
            gone = {k for x in r["removed"] for k in range(x["first"], x["end"])}
            assert len(gone) == r["n_removed"]
            assert any(r["text"] == " ".join(x for k, x in enumerate(w) if k not in gone) for w in texts[r["doc_id"]])
    assert sum(n for (_, size, kept), n in want.items() if len(kept) < size) > 100


def test_blocks_and_shards_of_any_size_give_the_same():
    """The steps by hand, in small blocks and buckets: patches do not reach Spark's workers."""
    rows = [(i, t) for i, t in passage_rows() if i is not None]
    base = []
    for at in range(0, len(rows), 7):
        buf, offs = words.as_bytes(pa.array([t for _, t in rows[at:at + 7]]))
        text, size, n = substring_dedup.normalised(buf, offs)
        raw = text.tobytes()
        base.append({"block": at, "n_words": int(n.sum()), "rows": [{"i": k} for k in range(at, min(at + 7, len(rows)))],
                     "ids": substring_dedup.pack(np.array([i for i, _ in rows[at:at + 7]])), "sizes": substring_dedup.pack(size.astype(np.int64)),
                     "text": len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)})
    base = pa.Table.from_pylist(base)

    def grouped(t, by, fn):
        return pa.concat_tables([fn(t.filter(pa.compute.equal(t.column(by), v))) for v in pa.compute.unique(t.column(by)).to_pylist()])

    def matched(t, by, fn):
        return pa.concat_tables([fn(base.slice(k, 1), t.filter(pa.compute.equal(t.column(by), base.column("block")[k]))) for k in range(base.num_rows)])

    asked = pa.Table.from_batches(list(substring_dedup._ask_anchors(base.to_batches(), 13, 6, 4)))
    shared = grouped(asked, "bucket", substring_dedup._shared_anchors)
    asked = matched(shared, "block", lambda b, a: substring_dedup._ask_windows(b, a, 13, 6, 4))
    owned = grouped(asked, "bucket", substring_dedup._owners)
    wanted = matched(owned, "block", lambda b, a: substring_dedup._passages(b, a, 13, 6))
    each = wanted.append_column("n", pa.array([1] * wanted.num_rows, pa.int64()))
    read = matched(each.drop_columns("block"), "from_block", substring_dedup._read_passages).to_pylist()
    texts = {(r["from_block"], r["from_at"], r["words"]): (r["text"], r["id"]) for r in read}
    out = collections.Counter()
    for k in range(base.num_rows):
        b = substring_dedup.Block(*(base.column(c)[k].as_py() for c in ("ids", "sizes", "text")))
        need = {}
        for r in wanted.to_pylist():
            if r["block"] == base.column("block")[k].as_py():
                t, i = texts[r["from_block"], r["from_at"], r["words"]]
                need[f" {t.decode()} "] = min(i, need.get(f" {t.decode()} ", i))
        wide = [f" {b.raw[lo:hi].decode()} " for lo, hi in zip(b.offs[:-1], b.offs[1:])]
        for i, n, t, spans in zip(b.ids.tolist(), b.n.tolist(), wide, substring_dedup.located(wide, b.ids.tolist(), need)):
            kept, gone, _ = substring_dedup._kept(t, spans)
            left = tuple(kept.split(" ")) if kept else ()
            assert len(left) == n - gone
            out[i, n, left] += 1
    assert out == without_repeats(rows)


def test_substring_dedup_of_nothing(spark, no_docs):
    out = substring_dedup.substring_dedup(no_docs, keep=["doc_id"])
    assert out.columns == ["doc_id", "text", "n_words", "n_removed", "removed"] and out.count() == 0


# -- 12 collocations ---------------------------------------------------------------------------

def phrases_by_hand(rows, least, longest=5, top=None):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for p in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split(r"[\x20\x09]+", p) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    all_ = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    gone = {(lang, p[i:i + k]) for (lang, p), a in all_.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if a >= f[lang, p[i:i + k]]}
    out = collections.defaultdict(list)
    for (lang, p), a in all_.items():
        if (lang, p) not in gone:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(v)[:top], 1))


def test_collocations(spark, rows, docs, no_docs):
    texts = [(r[2], r[1]) for r in rows]
    assert sorted(map(tuple, collocations.mine(docs, least=6, top=None).collect())) == phrases_by_hand(texts, 6)
    some = collocations.mine(docs, least=6, longest=3, top=4)
    assert some.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, some.collect())) == phrases_by_hand(texts, 6, 3, 4)
    assert collocations.mine(no_docs).count() == 0


def test_collocations_at_the_edges(spark):
    x, y = thue_morse(512)
    rows = [("en", "New York, new york! New; york new york"), ("en", "NEW YORK city " * 9), (None, "a a a a a a a"), ("und", "A a\na a"),
            ("en", None), ("en", ""), ("de", " \t . , "), ("de", "É é É é. ß ß\x0bß ß"), ("fr", f"{x} {y} " * 4), ("fr", f"{y} {x}. {x} {x}"),
            ("es", "uno dos tres cuatro cinco seis " * 5)]
    df = spark.createDataFrame(rows, "lang string, text string").select("*", F.lit(1).alias("n"), F.lit(2).alias("block"))
    for least in (1, 2, 4):
        assert sorted(map(tuple, collocations.mine(df, least=least, top=None).collect())) == phrases_by_hand(rows, least)


def test_long_texts_are_cut_between_pieces():
    text = "; ".join(" ".join(f"w{i % 7}" for i in range(k % 11)) for k in range(400)) + " tail without end " * 30
    buf, offs = words.as_bytes(pa.array([text, "", "short. text", text[:300]]))
    cuts, of = collocations.parts(buf, offs, 500)
    assert set(offs.tolist()) <= set(cuts.tolist()) and all(b - a <= 1100 for a, b in zip(cuts[:-1], cuts[1:]))
    assert collocations.parts(buf, offs, 1 << 20)[1].tolist() == [0, 1, 2, 3]
    assert of.tolist() == [int(np.searchsorted(offs, a, "right")) - 1 for a in cuts[:-1]]

    def neighbours(o):
        at, code, _, found = collocations.relation(buf, o)
        names = found.to_pylist()
        return collections.Counter((names[code[i]], names[code[i + 1]]) for i in np.flatnonzero(np.diff(at) == 1))

    assert neighbours(cuts) == neighbours(offs)


def test_scores_beyond_64_bits(spark):
    a, n, left, right = 3 * 10 ** 12, 7 * 10 ** 13 + 1, 5 * 10 ** 12 + 3, 4 * 10 ** 12 + 1
    df = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert df.select(collocations.score(*(F.col(c) for c in "anlr"))).first()[0] == 1000 * a * n // (left * right)


# -- 13 hard negatives ---------------------------------------------------------------------------

def negatives_by_hand(rows):
    ok = []
    for i, v, label in rows:
        if label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            ok.append((i, [math.floor(256 * c) for c in v], label))
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = collections.Counter()
    for at, (i, q, label) in enumerate(ok):
        if i is None or i % 100:
            continue
        scored = sorted(((sum(a * b for a, b in zip(q, r)), j, other) for k, (j, r, other) in enumerate(ok) if k != at and len(r) == len(q)), key=rank)
        for p, j, _ in [x for x in scored if x[2] == label][:5]:
            for k, (s, neg, _) in enumerate([x for x in scored if x[2] != label and 80 * p <= 100 * x[0] <= 100 * p][:5], 1):
                out[i, j, k, neg, p, s] += 1
    return out


def test_hard_negatives(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + i % 3)], int(rng.integers(0, 4))) for i in range(700)]
    rows += [(1000 + i, [0.5, 0.25, 0.5, 0.75, 0.5, 0.25], i % 2) for i in range(150)]         # a hot vector: ties by id
    rows += [(2000, [1.0] * 3, 0), (2001, [0.9] * 3, 0), (2002, [0.95] * 3, 1), (2100, [], 0), (2101, [], 0), (2102, [], 1),
             (2200, None, 0), (2300, [1.0] * 6, None), (2400, [1.0, None] * 3, 0), (2500, [float("nan")] * 6, 0),
             (2600, [float("inf")] * 6, 0), (2700, [-3.0] * 6, 77), (2701, [3.0] * 6, 77), (None, [1.0] * 6, 1), (300, [0.3] * 6, 2),
             (300, [0.3] * 6, 2), (2800, [0.0] * 6, 5), (2801, [0.0] * 6, 5), (2900, [1e5, 2.0], 1), (2901, [1e5, 1.0], 1), (2902, [9e4, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    df = df.select("*", F.lit(1).alias("row"), F.lit(2).alias("q"), F.lit(3).alias("tile"))
    want = negatives_by_hand(rows)
    assert len(want) > 100
    for tile, zones, part in ((512, 4096, 64), (2, 4, 3)):
        monkeypatch.setattr(hard_negatives, "TILE", tile)
        monkeypatch.setattr(hard_negatives, "ZONES", zones)
        monkeypatch.setattr(hard_negatives, "PART", part)
        out = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0)
        assert collections.Counter(map(tuple, out.collect())) == want
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 100 == 0).count() == 0


def test_the_curve_visits_neighbours():
    for dim, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
        keys = hard_negatives.hilbert(grid, bits)
        path = grid[sorted(range(len(grid)), key=keys.__getitem__)]
        assert len(set(keys)) == len(grid) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_skip_blocks():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 8)) * 4
    q = [np.floor(256 * (c + 0.05 * rng.normal(size=(60, 8)))).astype(np.int64) for c in centres]
    a = np.concatenate([x[:2] for x in q])
    lo, hi = np.stack([x.min(0) for x in q]), np.stack([x.max(0) for x in q])
    least, most = hard_negatives.bounds(a, lo, hi)
    for j, x in enumerate(q):
        s = a @ x.T
        assert (s.min(1) >= least[:, j]).all() and (s.max(1) <= most[:, j]).all()
    every = np.ones(least.shape, bool)
    read = hard_negatives.must_read(least, most, np.full(20, 60), every, every, 6)
    assert read.mean() < 0.3                    # blocks of near vectors: few must be read
    for i in range(len(a)):
        scores = np.concatenate([a[i] @ x.T for x in q])
        best = np.argsort(-scores, kind="stable")[:6] // 60
        assert read[i, best].all()


def test_words_are_counted_in_buckets():
    table = pa.table({"bucket": [3, 3], "block": [1, 2], "lang": ["en", "en"], "number": pa.array([[0, 1], [0]], pa.list_(pa.int32())),
                      "word": [["a", "b"], ["b"]], "ns": [[2, 3], [4]]})
    got = collocations._count_words(table, 3).to_pylist()
    number = 3 << 32
    assert [(r["lang"], r["word"], r["a"], r["id"]) for r in got if r["kind"] == 0] == [("en", "b", 7, number)]
    assert [(r["block"], r["number"], r["ids"]) for r in got if r["kind"] == 1] == [(1, [1], [number]), (2, [0], [number])]
